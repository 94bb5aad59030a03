"""Collocations, token files and lexical search against plain brute force."""
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from contractgate.llm import collocations, lexical_search, registry, token_files, word_ids
from contractgate.session import work_dir

SF = "/root/testdata/sf0.001"
VOCABULARY = P.path("word_bpe_49k.json")
# extra columns clash with names the operators use
DOCS = "doc_id bigint, text string, lang string, shard string, n string, rank int, tie int, lo int, terms string, part int"


def _docs(spark, rows):
    return spark.createDataFrame([(i, t, lang, "s", "n", 1, 2, 3, "t", 4) for i, t, lang in rows], DOCS)


def _phrases(rows, least, top):
    f, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", text):
            words = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(words)
            for m in range(1, 5):
                f[lang].update(" ".join(words[i:i + m]) for i in range(len(words) - m + 1))
    out = set()
    for lang, counts in f.items():
        found = {p: a for p, a in counts.items() if " " in p and a >= least}
        rows = []
        for p, a in found.items():
            w = p.split(" ")
            cuts = [(2_000_000 * a // (counts[" ".join(w[:k])] + counts[" ".join(w[k:])]), k) for k in range(1, len(w))]
            score, k = min(cuts)
            longer = [b for q, b in found.items() if len(q.split(" ")) > len(w) and f" {p} " in f" {q} "]
            if not any(100 * b >= 80 * a for b in longer):
                rows.append((-score, -a, p.encode(), counts[" ".join(w[:k])], counts[" ".join(w[k:])]))
        for rank, (score, a, p, left, right) in enumerate(sorted(rows)[:top], 1):
            out.add((lang, rank, p.decode(), -a, left, right, n[lang], -score))
    return out


def _result(df):
    return {tuple(r) for r in df.collect()}


def test_phrases_of_the_table_match_brute_force(spark):
    docs = pd.read_parquet(f"{SF}/documents.parquet")
    expected = _phrases(zip(docs.text, docs.lang), 30, 2000)
    assert expected and _result(registry.op11_itemset_phrases(spark, SF)) == expected


def test_phrases_whose_parts_become_frequent_late(spark):
    """Words, phrases and longer phrases that pass the threshold in different scans, ties, cuts at punctuation."""
    rng = random.Random(4)
    texts = []
    for k in range(120):
        words = [rng.choice("abcdefgh") for _ in range(rng.randrange(12))]
        if k % 3 == 0:
            words += ["New", "york", "city", "hall"]
        if k > 60:
            words += ["late", "late", "late", "comer"]
        texts.append(" ".join(words) + rng.choice(["", ". new york", "\tNEW\tyork; city hall", "\x0bx\x0cy"]))
    rows = [(k, t, rng.choice(["en", "de", None])) for k, t in enumerate(texts)]
    rows += [(200, None, "en"), (201, "", "fr"), (7, texts[7], "en"), (7, texts[7], "en"), (None, "x " * 30_000, "en"), (202, " é\x85 ö " * 9, "fr")]
    for shards, least in ((3, 7),):
        got = _result(collocations.phrases(_docs(spark, rows), least=least, top=40, shards=shards))
        assert got == _phrases([(t, lang) for _, t, lang in rows], least, 40)


def test_phrases_do_not_depend_on_the_size_of_the_slot_table(spark, monkeypatch):
    docs = pd.read_parquet(f"{SF}/documents.parquet").head(60)
    rows = list(zip(docs.doc_id.tolist(), docs.text, docs.lang))
    monkeypatch.setattr(collocations, "SLOTS", 1 << 6)  # nearly every slot is shared
    lots = [collocations._counted([t.encode() for _, t, lang in rows if lang == "en"], "en", 3, 3,
                                  [np.full(1 << 6, 1 << 2, dtype=np.uint16) for _ in range(3)])]
    counted = Counter({p: n for length, ps, _, ns in lots[0] if length == 2 for p, n in zip(ps.to_pylist(), ns.tolist())})
    plain = Counter()
    for _, t, lang in rows:
        if lang == "en":
            for piece in re.split("[.,;:!?\x0a-\x0d]", re.sub("[A-Z]", lambda m: m[0].lower(), t)):
                w = piece.split()
                plain.update(" ".join(x) for x in zip(w, w[1:]))
    assert counted == plain


def test_phrases_of_an_empty_table(spark):
    assert collocations.phrases(_docs(spark, [])).collect() == []


def test_word_ids_are_the_library_s():
    library, own = Tokenizer.from_file(VOCABULARY), word_ids.WordIds(VOCABULARY)
    rng = random.Random(2)
    parts = [*"abcdeABCDEstrvmld''..,!?;:()-_0123<|>/$  \n\t\r", "é", "ß", "ñ", "İ", "ſ", "́", "中", "𝒳", "　", "\x1c", "\x85",
             "<|endoftext|>", "<|startoftext|>", "'s", "'LL", "ing", "Å", "µ", "²", "½", "ª", "ŉ", "×", "\x00"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(25))) for _ in range(4000)]
    for text, ids in zip(texts, own.encode(texts)):
        assert np.frombuffer(ids, own.dtype).tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)


def test_word_ids_after_forgetting(monkeypatch):
    monkeypatch.setattr(word_ids, "REMEMBERED", 50)
    own = word_ids.WordIds(VOCABULARY)
    texts = [" ".join(f"w{k % 97}x{k % 7}" for k in range(n, n + 60)) for n in range(0, 2000, 60)]
    library = Tokenizer.from_file(VOCABULARY)
    for t in texts:
        assert np.frombuffer(own.encode([t])[0], own.dtype).tolist() == library.encode(t, add_special_tokens=False).ids
        assert len(own.known) <= 121


def _expected_files(rows):
    library, at, out = Tokenizer.from_file(VOCABULARY), 0, []
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = library.encode(text or "", add_special_tokens=False).ids + [2]
        out.append((doc_id, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


def test_token_files_of_the_table_match_the_library(spark):
    docs = pd.read_parquet(f"{SF}/documents.parquet")
    assert _result(registry.op12_token_files(spark, SF)) == set(_expected_files(zip(docs.doc_id.tolist(), docs.text)))


def test_token_files_defined_cases(spark):
    rows = [(9, "b"), (3, None), (4, ""), (None, "none of it"), (-5, "word " * 40_000), (9, "b"), (2, "Été, 12's <|endoftext|>")]
    folder = work_dir(spark, "llm/test-files", fresh=True)
    token_files.write_token_files(_docs(spark, [(*r, "en") for r in rows]).repartition(3), folder, VOCABULARY, parts=3)
    back = token_files.read_token_files(spark, folder, keep_ids=True).collect()
    assert sorted((r.start, r.doc_id, r.n_tokens, r.ids_crc32) for r in back) == sorted((s, i, n, c) for i, s, n, c in _expected_files(rows))
    files = token_files.TokenFiles(spark, folder)
    assert len(files) == len(rows)
    by_start = sorted(back, key=lambda r: r.start)
    assert all(files[k].tolist() == by_start[k].ids for k in range(len(files)))
    with pytest.raises(IndexError):
        files[len(rows)]


def test_token_files_of_an_empty_table(spark):
    folder = work_dir(spark, "llm/test-files", fresh=True)
    token_files.write_token_files(_docs(spark, []), folder, VOCABULARY)
    assert token_files.read_token_files(spark, folder).count() == 0
    assert len(token_files.TokenFiles(spark, folder)) == 0


TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def _ranked(docs, items, k=10):
    def terms(text):
        return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    held = [(i, Counter(terms(t))) for i, t in docs]
    held = [(i, c, sum(c.values())) for i, c in held if c]
    N, L = len(held), sum(n for *_, n in held)
    df = Counter(t for _, c, _ in held for t in c)
    out = set()
    for item, text in items:
        scored = []
        for i, c, n in held:
            m = 25 + 75 * n * N // L
            s = sum(math.floor(1000 * math.log((2 * N + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m)) for t in terms(text) if c[t])
            if s > 0:
                scored.append((-s, i is None, i or 0, i))
        out |= {(item, rank, r[3], -r[0]) for rank, r in enumerate(sorted(scored)[:k], 1)}
    return out


def test_search_matches_brute_force(spark, monkeypatch):
    docs, items = (pd.read_parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    expected = _ranked(list(zip(docs.doc_id.tolist(), docs.text)), list(zip(items.item_id.tolist(), items.text)))
    assert _result(registry.op13_interval_search(spark, SF)) == expected


@pytest.mark.parametrize("postings,leaf,wave", [(64, 8, 3), (1 << 20, 1, 1), (300, 4, 16)])
def test_search_in_small_shards_and_intervals(postings, leaf, wave, monkeypatch):
    """Best-first over splits and over many shards, with ties, gives what scoring all documents gives."""
    import pyarrow as pa
    monkeypatch.setattr(lexical_search, "SHARD_POSTINGS", postings)
    monkeypatch.setattr(lexical_search, "LEAF", leaf)
    monkeypatch.setattr(lexical_search, "WAVE", wave)
    rng = np.random.default_rng(postings + leaf)
    docs = []
    for i in range(250):
        held = np.unique(rng.zipf(1.4, rng.integers(0, 12)) % 30)
        docs.append((int(rng.permutation(250)[0]) if i % 9 else 7, len(held) + 2, held.tolist(), rng.integers(1, 4, len(held)).tolist()))
    docs += docs[:40]  # copies
    w = lexical_search.Weights(len(docs), sum(n for _, n, *_ in docs), rng.integers(0, 900, 30))
    batch = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*docs), (pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32())))],
                                       names=["doc_id", "n", "terms", "tfs"])
    for _ in range(12):
        term = np.sort(rng.permutation(30)[: rng.integers(1, 12)])
        repeats = rng.integers(1, 3, len(term))
        best = lexical_search.Best(10)
        for shard in lexical_search.shards(iter([batch.slice(0, 100), batch.slice(100)]), w):
            lexical_search.search(shard, term, repeats, best)
        own = dict(zip(term.tolist(), repeats.tolist()))
        scored = sorted((-sum(own[t] * int(w.impacts(np.array([t]), np.array([f]), np.array([n]))[0]) for t, f in zip(ts, fs) if t in own), i)
                        for i, n, ts, fs in docs)
        assert [(-s, i) for s, i in scored if s < 0][:10] == list(zip(best.scores.tolist(), best.ids.tolist()))


def test_search_defined_cases(spark, monkeypatch):
    monkeypatch.setattr(lexical_search, "BLOCK_BYTES", 40)  # several blocks of items
    docs = [(1, "alpha beta beta"), (2, "Alpha-BETA é"), (2, "Alpha-BETA é"), (3, None), (4, ""), (None, "alpha gamma"), (5, "x " * 50_000 + "gamma"), (6, "...")]
    items = [(10, "ALPHA beta"), (10, "ALPHA beta"), (11, None), (12, ""), (None, "gamma gamma é"), (13, "nowhere"), (14, "x é alpha")]
    frame = spark.createDataFrame([(i, t, 1, 2) for i, t in items], "item_id bigint, text string, doc_id int, score int")
    got = _result(lexical_search.ranked(_docs(spark, [(*d, "en") for d in docs]), frame))
    assert got == _ranked(docs, dict(items).items())
    assert lexical_search.ranked(_docs(spark, []), frame).count() == 0
    assert lexical_search.ranked(_docs(spark, [(1, "a", "en")]), frame.where("false")).count() == 0


def test_counts_of_phrases_travel_as_a_few_bytes_and_add_up():
    """Counts of two tasks over three scans, added up part by part; each takes well below the bytes of its phrase."""
    import pyarrow as pa
    rng, parts, known, bits = np.random.default_rng(21), {}, {}, 3
    words = [f"w{k}" for k in range(3000)]
    texts = [" ".join(rng.choice(words, 400)) for _ in range(90)]
    batch = lambda own: pa.RecordBatch.from_arrays([pa.array(["en"] * len(own)), pa.array(own)], names=["lang", "text"])
    for scan in range(3):
        own = texts[scan::3]
        found = [r for half in (own[::2], own[1::2]) for b in collocations._counter(scan, 3, None, bits)(iter([batch(half)])) for r in b.to_pylist()]
        assert sum(len(r["data"]) for r in found) < 9 * sum(r["size"] for r in found)
        rows = sorted([*found, *(r for own in parts.values() for r in own)], key=lambda r: r["part"])
        table = pa.RecordBatch.from_pylist(rows)
        parts = {}
        for b in collocations._adder(scan, 3, 15)(table.slice(i, 5) for i in range(0, table.num_rows, 5)):  # a part's rows in several batches
            for r in b.to_pylist():
                parts.setdefault(r["part"], []).append(r)
                if r["kind"] == collocations._KNOWN:
                    for key in collocations._unpack(r["data"], r["size"])[0].tolist():
                        assert known.setdefault(key, scan) == scan  # once
    plain = Counter(w for t in texts for w in t.split())
    expected = collocations._keys(1, collocations.word_hashes([w.encode() for w, n in plain.items() if n >= 15], "en"))
    assert 0 < len(known) < len(plain) and set(known) == set(expected.tolist())
    assert not any(r["kind"] == collocations._OPEN for own in parts.values() for r in own)  # every cycle is full
