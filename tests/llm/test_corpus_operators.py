"""Near-duplicates, lines, neighbours, mixture, classifiers and the pipeline."""
import math
import re
from collections import Counter

import numpy as np
import pandas as pd
import pytest

import corpus_pipeline
from contractgate.llm import alignment, common, groups, line_dedup, mixing, near_dup, nearest, registry, subword_classifier, toxicity, words

SF = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, row bigint, id string"


def _docs(spark, rows):
    return spark.createDataFrame([(i, t, "en", "src1", None, 1, "x") for i, t in rows], DOCS)


def _groups(ids, linked):
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    ids = list(ids)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            if linked(a, b):
                parent[max(find(a), find(b))] = min(find(a), find(b))
    return {i: find(i) for i in ids}


def test_near_duplicates_of_the_table_match_brute_force(spark):
    docs = pd.read_parquet(f"{SF}/documents.parquet")
    found = {r.doc_id: r.class_id for r in registry.op1_order_minhash(spark, SF).collect()}
    own = {i: words.word_hashes(t)[0] for i, t in zip(docs.doc_id, docs.text)}
    assert found == _groups(sorted(own), lambda a, b: alignment.alike(own[a], own[b], 0.8))


def test_near_duplicates_defined_cases(spark):
    rng = np.random.default_rng(3)
    base = [f"w{x}" for x in rng.integers(0, 400, 200)]
    near = [" ".join(base[:k] + ["changed"] + base[k + 1:]) for k in range(0, 200, 5)]  # forty near copies
    rows = [(0, " ".join(base)), *((i + 1, t) for i, t in enumerate(near)), (100, ""), (101, None), (102, "..."), (103, "a b"),
            (104, "A, b!"), (103, "a b"), (None, " ".join(base)), (105, "w1 " * 20_000), (106, "w1 " * 20_000 + "end")]
    got = near_dup.near_duplicates(_docs(spark, rows).repartition(3)).collect()
    assert len(got) == len(rows)
    classes = {r.doc_id: r.class_id for r in got}
    assert all(classes[i] == 0 for i in range(41)) and classes[None] == 0
    assert [classes[i] for i in (100, 101, 102, 103, 104, 105, 106)] == [100, 101, 102, 103, 103, 105, 105]
    assert Counter(r.class_id for r in got if r.kept) == {0: 1, 100: 1, 101: 1, 102: 1, 103: 1, 105: 1}
    assert near_dup.near_duplicates(_docs(spark, [])).count() == 0
    kept = near_dup.deduplicated(_docs(spark, rows))
    assert kept.columns == DOCS.replace(" bigint", "").replace(" string", "").split(", ") and kept.count() == 6


def test_lines_match_brute_force(spark):
    docs = pd.read_parquet(f"{SF}/documents.parquet")
    text = dict(zip(docs.doc_id, docs.text))
    out = {r.doc_id: r.text for r in registry.op6_simhash_lines(spark, SF).collect()}
    assert set(out) == set(text)
    forms, lines = {}, []
    for i in docs.doc_id:  # the table's order
        for k, line in enumerate(text[i].split("\n")):
            hashes = words.word_hashes(line)[0]
            if len(hashes):
                lines.append((i, k, forms.setdefault(hashes.tobytes(), (len(forms), line, hashes))[0]))
    sims = np.array([line_dedup.simhashes(h, np.array([0]))[0] for _, _, h in forms.values()])
    label = list(range(len(forms)))
    texts = [line for _, line, _ in forms.values()]
    code = lambda line: words.code_points(" ".join(line.lower().split()))
    for a in range(len(sims)):
        near = np.flatnonzero(np.bitwise_count(sims ^ sims[a]) <= line_dedup.RADIUS)
        for b in near[near < a]:
            if alignment.alike(code(texts[a]), code(texts[b]), 0.8):
                lo, hi = sorted((label[a], label[b]))
                label = [lo if x == hi else x for x in label]
    seen, gone = set(), {}
    for i, k, form in lines:
        if label[form] in seen:
            gone.setdefault(i, set()).add(k)
        seen.add(label[form])
    for i, t in text.items():
        assert out[i] == "\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone.get(i, ())), i


def test_lines_defined_cases(spark):
    long = " ".join(f"word{k}" for k in range(120))
    rows = [(1, "First line here\n\nsecond, LINE\n***"), (2, "SECOND line\n\nown text of two\n***"), (3, None), (4, ""),
            (5, "First line here\nFirst   line, here"), (5, "First line here\nFirst   line, here"), (None, long), (7, long.replace("word7 ", "wordx "))]
    got = [(r.doc_id, r.text, r.lines_dropped) for r in line_dedup.dedup_lines(_docs(spark, rows).coalesce(1)).collect()]
    assert sorted(got, key=str) == sorted([
        (1, "First line here\n\nsecond, LINE\n***", 0), (2, "\nown text of two\n***", 1), (3, None, 0), (4, "", 0),
        (5, "", 2), (5, "", 2), (None, long, 0), (7, long.replace("word7 ", "wordx "), 0)], key=str) or got[-1][2] == 1
    assert line_dedup.dedup_lines(_docs(spark, [])).count() == 0


def test_neighbours(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(600, 24))
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(x)]
    rows += [(5, rows[5][1]), (1000, rows[5][1]), (1001, None), (1002, []), (1003, [0.0] * 24), (1004, [float("nan")] + [1.0] * 23),
             (1005, [None] + [1.0] * 23), (1006, [float("inf")] + [1.0] * 23), (1100, [1.0, 2.0, 3.0]), (None, rows[7][1])]
    df = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id bigint, embedding array<double>, label int, rank int")
    ask = (df.vec_id % 100 == 0) | (df.vec_id == 5)
    got = nearest.nearest(df, ask, k=10, chunk_rows=100, block_rows=3).toPandas()
    ids = np.array([*range(600), 1000])
    all_x = np.vstack([x, x[5]])
    hits = 0
    for q in [0, 100, 200, 300, 400, 500, 5, 1000]:
        d = np.sqrt(((all_x - all_x[list(ids).index(q)]) ** 2).sum(axis=1))
        order = [k for k in np.lexsort((ids, d)) if ids[k] != q][:10]
        own = got[got.query_id == q].sort_values("rank")
        assert list(own["rank"]) == list(range(1, len(own) + 1))
        assert dict(zip(own.vec_id, own.score)).items() <= dict(zip(ids, d)).items()
        assert list(zip(own.score, own.vec_id)) == sorted(zip(own.score, own.vec_id))
        hits += len(set(own.vec_id) & set(ids[order]))
    assert hits >= 0.9 * 80
    assert got[(got.query_id == 5) & (got["rank"] == 1)].vec_id.item() == 1000
    assert set(got.query_id) == {0, 100, 200, 300, 400, 500, 5, 1000}  # 1100 has no other vector of its length
    assert nearest.nearest(df.where("false"), ask).count() == 0


def _filled(budget, children):
    """Water-filling by rounds: children name -> (weight, capacity)."""
    got, left = dict.fromkeys(children, 0), dict(children)
    while left:
        total = sum(w for w, _ in left.values())
        short = {n for n, (w, c) in left.items() if w and c * total <= budget * w}
        if not short:
            return got | {n: budget * w // max(total, 1) for n, (w, _) in left.items()}
        n = min(short, key=lambda n: (left[n][1] / left[n][0], n))
        got[n] = left[n][1]
        budget -= left.pop(n)[1]
    return got


def test_mixture_matches_a_plain_computation(spark):
    docs = pd.read_parquet(f"{SF}/documents.parquet")
    got = registry.op8_hierarchical_mix(spark, SF).toPandas()
    assert sorted(got.doc_id) == sorted(docs.doc_id)
    w = registry.MIX["weights"]
    leaves = got.groupby(["domain", "lang", "source"]).tokens.sum()
    total = leaves.sum() * registry.MIX["percent"] // 100
    caps = leaves * registry.MIX["max_epochs"]
    per_domain = _filled(total, {d: (w["domain"].get(d, 1), int(c)) for d, c in caps.groupby(level=0).sum().items()})
    for d, budget in per_domain.items():
        per_lang = _filled(budget, {x: (w["lang"].get(x, 1), int(c)) for x, c in caps[d].groupby(level=0).sum().items()})
        for x, budget_x in per_lang.items():
            per_source = _filled(budget_x, {s: (1, int(c)) for s, c in caps[d][x].items()})
            for s, b in per_source.items():
                own = got[(got.domain == d) & (got.lang == x) & (got.source == s)]
                n = int(own.tokens.sum())
                taken = int((own.tokens * own.copies).sum())
                assert taken <= b and own.copies.max() - own.copies.min() <= 1
                assert b - taken < own.tokens.max() or b >= n * registry.MIX["max_epochs"]


def test_mixture_defined_cases(spark):
    rows = [(1, "a b c", "en", "s"), (1, "a b c", "en", "s"), (2, None, None, "s"), (3, "", "en", None), (None, "x y", "de", "s"), (4, "q", "en", "t")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    from pyspark.sql import functions as F
    got = mixing.mix(df, F.lit("d"), {}, percent=100, max_epochs=1).collect()
    assert len(got) == 6 and {(r.doc_id, r.mix_copies) for r in got} == {(1, 1), (2, 0), (3, 0), (None, 1), (4, 1)}
    assert mixing.mix(df.where("false"), F.lit("d"), {}).count() == 0
    none = mixing.mix(df, F.lit("d"), {"lang": {"en": 0}}, percent=50, max_epochs=1).collect()
    assert {r.mix_copies for r in none if r.lang == "en"} == {0}


@pytest.mark.parametrize("query,label,floor", [("op4_subword_quality", "quality", 0.95), ("op5_pattern_toxicity", "toxic", 0.85)])
def test_classifiers_on_rows_they_have_not_seen(spark, query, label, floor):
    sf = "/root/testdata/sf0.1"
    got = registry.QUERIES[query](spark, sf).toPandas()
    assert len(got) == len(pd.read_parquet(f"{sf}/documents.parquet", columns=["doc_id"])) and got.score.between(0, 1).all()
    assert ((got.score >= 0.5) == (got.predicted == 1)).all()
    held = got[got.held_out].merge(pd.read_parquet(f"{sf}/labels.parquet"), on="doc_id")
    rank, y = held.score.rank(), held[label]
    auc = (rank[y == 1].sum() - y.sum() * (y.sum() + 1) / 2) / (y.sum() * (len(y) - y.sum()))
    assert auc > floor


def test_classifiers_defined_cases(spark):
    docs = _docs(spark, [(1, None), (2, ""), (3, "good plain words " * 30), (4, "### $$$ " * 50), (4, "### $$$ " * 50), (None, "x" * 300_000)])
    for rows in ([], [(3, 1, 0)], [(3, 1, 0), (4, 0, 1), (3, None, None), (99, 1, 1)]):
        labels = spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int")
        from pyspark.sql import functions as F
        a = subword_classifier.score(docs, subword_classifier.fit(docs, labels, "quality", F.lit(True)))
        b = toxicity.score(docs, toxicity.fit(docs, labels, "toxic", F.lit(True)))
        for scored in (a, b):
            assert scored.columns == [*docs.columns, "score"]
            assert all(0 <= r.score <= 1 for r in scored.collect()) and scored.count() == 6
    assert a.where("doc_id = 3").first().score > 0.5 > a.where("doc_id = 4").first().score


def test_grammar_reads_clauses():
    g = toxicity.Grammar({"idiot": 2.0, "fool*": 1.0})
    found = lambda t: {k: v for k, v in g.matches(t)[0].items() if v}
    assert found("what an idiot") == {"plain": 2.0}
    assert found("you idiot") == {"addressed": 2.0}
    assert found("he is not an idiot. an idiot") == {"negated": 2.0, "plain": 2.0}
    assert found("the paper said some foolish thing") == {"reported": 1.0}
    assert found("i will hurt nobody; you will hurt") == {"threat": 1.0}


def test_pipeline(spark, tmp_path):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality classifier", "line dedup", "near-duplicates", "mixture", "packing"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF)
        out.write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        if k < 4:
            assert docs.columns == columns and 0 < docs.count() <= before
            before = docs.count()
    assert docs.select("doc_id").distinct().count() == before
    text = {r.doc_id: r for r in spark.read.parquet(str(tmp_path / "1")).collect()}
    assert all(r.n_chars == len(r.text) for r in text.values()) and any(re.search(r"\w", r.text) for r in text.values())


def test_pipeline_on_an_empty_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("false")
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).count() == 0, name


def test_lines_with_changed_words_go_whatever_their_simhash(spark):
    rng = np.random.default_rng(8)
    base = [" ".join("".join(rng.choice(list("abcdefghinorst"), rng.integers(3, 9))) for _ in range(n)) for n in (10, 12, 20, 40, 60)]
    changed = [" ".join("other" if k == 4 else w for k, w in enumerate(line.split())) for line in base]
    rows = [(i, line) for i, line in enumerate([*base, "The red.", *changed, "Tha red."])]
    code = lambda line: words.code_points(" ".join(line.lower().split()))
    assert all(alignment.alike(code(a), code(b), 0.8) for (_, a), (_, b) in zip(rows[:6], rows[6:]))
    got = {r.doc_id: r.lines_dropped for r in line_dedup.dedup_lines(_docs(spark, rows).coalesce(1)).collect()}
    assert got == {i: int(i > 5) for i in range(12)}


def test_a_large_bucket_gives_the_links_of_all_its_pairs(spark):
    members = spark.createDataFrame([(b, i, 100 + i) for b in (1, 2) for i in range(40) if b == 1 or i % 2], "bucket bigint, id bigint, next bigint")
    chained = lambda pairs: common.materialise(pairs.where("b - a = 3"), "chained")  # noqa: E731 - no centre sees a chain
    got = {r.id: r.label for r in groups.linked(members, chained).collect()}
    assert got == {i: i % 3 for i in range(40)}


def test_pairs_near_the_threshold_share_a_sketch():
    import inspect
    settings = {k: v.default for k, v in inspect.signature(near_dup.near_duplicates).parameters.items()}
    rng, factors, hits = np.random.default_rng(9), near_dup.factors_of(settings["sketches"], settings["seed"]), 0
    for _ in range(100):
        a, changed = rng.integers(1, 1 << 63, 300).astype(np.uint64), rng.choice(300, 54, replace=False)
        b = a.copy()
        b[changed] += np.uint64(1)
        assert alignment.alike(a, b, settings["similarity"])
        x, y = (near_dup.sketch(near_dup.kmers(w, settings["size"]), factors, settings["keep"]) for w in (a, b))
        hits += (x == y).any()
    assert hits >= 95


def test_grammar_reads_threats_before_their_target(spark):
    from pyspark.sql import functions as F
    g = toxicity.Grammar({"idiot": 2.0})
    found = lambda t: {k: v for k, v in g.matches(t)[0].items() if v}
    assert found("i will kill you") == found("we hurt all of them") == found("you will kill you") == {"threat": 1.0}
    for text in ("i will not kill you", "the paper said i will kill you", "kill. you", "kill the very old dog you"):
        assert found(text) == {}, text
    plain = "good plain words about the weather "
    docs = _docs(spark, [(i, plain * 5 + ("idiot moron " * 4 if i % 2 else "")) for i in range(60)])
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id bigint, toxic int")
    grammar = toxicity.fit(docs, labels, "toxic", F.lit(True))
    assert grammar.score(plain + "i will kill you") > 0.5 > grammar.score(plain + "i will see you")


def test_copies_of_symbol_only_texts_are_one_class(spark):
    rows = [(1, "===="), (2, "***"), (3, " ====\n"), (4, "===="), (5, "== =="), (6, ""), (7, None), (8, " ")]
    got = {r.doc_id: r.class_id for r in near_dup.near_duplicates(_docs(spark, rows).repartition(3)).collect()}
    assert got == {1: 1, 2: 2, 3: 1, 4: 1, 5: 5, 6: 6, 7: 7, 8: 8}
    assert near_dup.deduplicated(_docs(spark, rows)).count() == 6


def test_threats_have_an_object_or_end_the_clause():
    g = toxicity.Grammar({"idiot": 2.0})
    found = lambda t: {k: v for k, v in g.matches(t)[0].items() if v}
    for text in ("i am killing you", "he kills you", "she is stabbing you", "you will burn", "you'll surely burn", "i\u2019ll kill you", "we beat him"):
        assert found(text) == {"threat": 1.0}, text
    for text in ("you can't kill", "you won't hurt him", "they doesn't hurt", "i cannot beat you", "you shoot photos of birds",
                 "they beat us by three goals", "she will burn calories", "you can\u2019t hurt anything", "do you shoot"):
        assert found(text) == {}, text
    assert found("she will kill them with kindness") == {"threat": 0.25}
    assert found("he isn't an idiot") == {"negated": 2.0}


def test_no_kind_of_match_lowers_a_toxicity_score():
    rng = np.random.default_rng(2)
    x = rng.random((300, len(toxicity._INPUTS))) * (rng.random((300, len(toxicity._INPUTS))) < 0.4)
    y = (2 * x[:, 1] - x[:, 0] + x[:, 4] > 0.5).astype(float)  # plain insults less, negated ones more often in toxic rows
    weights = dict(zip(toxicity._INPUTS, toxicity._logistic(x, y)[0]))
    assert min(weights.values()) >= 0 and max(weights["negated"], weights["reported"]) <= weights["plain"] + 1e-12


def test_scores_are_those_of_a_plain_count(spark):
    """Both scores anew with plain loops over the whole text, from the fitted weights alone."""
    from pyspark.sql import functions as F
    docs, labels = (spark.read.parquet(f"{SF}/{name}.parquet") for name in ("documents", "labels"))
    extra = _docs(spark, [(-1, None), (-2, ""), (-3, "a"), (-4, "naïve 🙂 words " * 40_000)]).select("doc_id", "text")
    rows = docs.select("doc_id", "text").limit(40).unionByName(extra)
    model = subword_classifier.fit(docs, labels, "quality", F.lit(True), bits=12)
    base, mix, whole = 0x9E3779B97F4A7C15 | 1, 0xBF58476D1CE4E5B9, 1 << 64

    def hashed(part):
        h = 0
        for c in reversed(part):
            h = (h * base + ord(c) + 1) % whole
        return h

    def bucket(h, salt):
        return ((h + salt) * mix % whole) >> (64 - 12)

    def plain(text):
        ids = [bucket(hashed(text[i:i + n]), n) for n in (3, 4, 5) for i in range(len(text) - n + 1)]
        own = [hashed(w) for w in re.split("[ \t-\r]+", text) if w]
        ids += [bucket(h, 101) for h in own]
        ids += [bucket(0 if a == b else (a * 31 + b) % whole, 103) for a, b in zip(own, own[1:])]
        z = sum(float(model.weights[i]) for i in ids) / max(len(ids), 1) + model.bias
        return 1 / (1 + math.exp(-z))

    for r in subword_classifier.score(rows, model).collect():
        if len(r.text or "") < 100_000:
            assert r.score == pytest.approx(plain(r.text or ""), abs=1e-9), r.doc_id
    grammar = toxicity.Grammar({"idiot": 2.0, "the": 0.5, "fool*": 1.0}, dict.fromkeys(toxicity._INPUTS, 0.7), -2.0)

    def kinds(text):
        found = dict.fromkeys(toxicity.KINDS, 0.0)
        for clause in re.split("[.!?;\n]", text.lower()):
            own = toxicity._WORD.findall(clause)
            for i, w in enumerate(own):
                weight = 2.0 if w == "idiot" else 0.5 if w == "the" else 1.0 if w[:4] == "fool" and len(w) > 4 else 0.0
                before = own[max(i - 3, 0):i]
                if weight:
                    found["negated" if any(toxicity._cue(b) == "negation" for b in before if b != "the") else
                          "reported" if any(b in toxicity.REPORTS for b in own[:i]) else
                          "addressed" if any(toxicity._cue(b).startswith(("second", "third")) for b in before) else "plain"] += weight
        return found

    for r in toxicity.score(rows, grammar).collect():
        found, n = kinds(r.text or ""), len(toxicity._WORD.findall((r.text or "").lower()))
        if grammar.matches(r.text or "")[0]["threat"]:
            continue
        x = [*(math.log1p(v) for v in found.values()), math.log1p(100 * sum(found.values()) / max(n, 1))]
        assert r.score == pytest.approx(1 / (1 + math.exp(2.0 - 0.7 * sum(x)))), r.doc_id
