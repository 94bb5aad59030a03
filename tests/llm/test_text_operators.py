"""Alignment, token counts, packing, exact dedup, secrets: against brute force."""
import hashlib
import math
import random
import re
import zlib

import numpy as np
import public_tokenizers as P
import pytest

from contractgate.llm import alignment, exact_dedup, packing, secret_scan, token_count

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, extra string, row string, length int"
AWKWARD = ["", None, " ", "\n\n", "a", "two  spaces", " lead", "trail ", "x \n y", "x \n \n y", "tab\t b", "ünï cödé 漢字 🙂",
           "<|endoftext|> in <s>text</s>", "it's we'll 12345", "a" * 5000, " ".join(["word"] * 3000), "line\r\nline\x0b\x0c"]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", f"src{i % 3}", None, None, "r", 3) for i, t in enumerate(AWKWARD)]
    rows += [(3, AWKWARD[3], "en", "src0", None, None, "r", 3), (None, "no id", None, None, 1, "e", None, None)]
    return spark.createDataFrame(rows, DOCS).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def _distance(a, b):
    before = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        now = [i]
        for j, y in enumerate(b, 1):
            now.append(min(before[j] + 1, now[-1] + 1, before[j - 1] + (x != y)))
        before = now
    return before[-1]


def test_alignment_is_the_edit_distance():
    rng = random.Random(1)
    for _ in range(400):
        a = [rng.randint(0, rng.choice([2, 30])) for _ in range(rng.randint(0, 40))]
        b = [x for x in a if rng.random() > 0.1] + [rng.randint(0, 9) for _ in range(rng.randint(0, 8))]
        d = _distance(a, b)
        for limit in (0, 2, 8, 11, 60):
            assert alignment.distance_within(np.array(a, dtype=int), np.array(b, dtype=int), limit) == (d if d <= limit else None)


def test_wide_alignment():
    rng = np.random.default_rng(2)
    a = rng.integers(0, 50, 600)
    b = np.delete(a, rng.choice(600, 120, replace=False))
    assert alignment.distance_within(a, b, 130) == 120 and alignment.distance_within(a, b, 119) is None


def test_token_counts(spark, docs, empty):
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    got = token_count.token_counts(docs, P.path("piece_bpe_32k.model"), limit=100)
    text = {r.doc_id: r.text or "" for r in docs.collect()}
    rows = got.collect()
    assert len(rows) == docs.count()
    for r in rows:
        n = len(model.encode(text[r.doc_id]))
        assert (r.n_tokens, r.n_bytes, r.over_limit) == (n, len(text[r.doc_id].encode()), n > 100), r
    assert token_count.token_counts(empty, P.path("piece_bpe_32k.model")).count() == 0


@pytest.mark.parametrize("ranks", [None, "byte_bpe_50k.tiktoken"])
def test_packing_round_trip(docs, empty, ranks):
    from tokenizers import Tokenizer
    library = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    settings = {"vocabulary": P.path("byte_bpe_50k.json"), "capacity": 64, "ranks": ranks and P.path(ranks), "pattern": P.PATTERN}
    rows = packing.best_fit_pack(docs, keep_ids=True, **settings).collect()
    text = {r.doc_id: r.text or "" for r in docs.collect()}
    by_doc, by_sequence = {}, {}
    for r in rows:
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, dtype="<u4").tobytes()) and r.length == len(r.ids) <= 64
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    for doc_id, own in by_doc.items():
        ids = library.encode(text[doc_id], add_special_tokens=False).ids + [2]
        copies = 2 if doc_id == 3 else 1
        own.sort(key=lambda r: r.start)
        assert sorted(sum((r.ids for r in own), [])) == sorted(ids * copies)
        if copies == 1:
            assert sum((r.ids for r in own), []) == ids
            assert len(own) == 1 or all(r.length == 64 for r in own[1:])
    for own in by_sequence.values():
        own.sort(key=lambda r: r.offset)
        assert [r.offset for r in own] == [sum(x.length for x in own[:k]) for k in range(len(own))]
        assert sum(r.length for r in own) <= 64
    assert set(by_doc) == set(text)
    assert packing.best_fit_pack(empty, **settings).count() == 0


def test_plan_packs_everything_tightly():
    rng = np.random.default_rng(5)
    lengths = np.minimum(rng.geometric(0.004, 20_000), 1024)
    counts = dict(zip(*map(np.ndarray.tolist, np.unique(lengths, return_counts=True))))
    made = packing.plan(counts, 1024)
    used = {}
    for inside, times in made:
        assert sum(inside) <= 1024 and times > 0
        for x in inside:
            used[x] = used.get(x, 0) + times
    assert used == counts
    assert sum(t for _, t in made) <= math.ceil(lengths.sum() / 1024) * 1.01 + 1


def test_best_two_replaces_the_smallest():
    # greedy alone gives 60 + 30; two smaller pieces fill the gap exactly
    assert ([60, 25, 15], 1) in packing.plan({60: 1, 30: 1, 25: 1, 15: 1}, 100)


@pytest.mark.parametrize("digest_all", [True, False])
def test_exact_dedup(docs, empty, digest_all):
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]", "", t or "")
    source = [(r.doc_id, r.text or "") for r in docs.collect()]
    rows = exact_dedup.exact_dedup(docs, digest_all=digest_all).collect()
    assert len(rows) == len(source)
    groups = {}
    for doc_id, text in source:
        groups.setdefault(norm(text), []).append((-len(text), doc_id is None, doc_id))
    text = dict(source)
    for r in rows:
        own = groups[norm(text[r.doc_id])]
        assert (r.group_size, r.keep_id) == (len(own), min(own)[2]), r
        if digest_all or r.group_size > 1:
            assert r.text_sha256 == hashlib.sha256(norm(text[r.doc_id]).encode()).hexdigest()
    assert sum(r.kept for r in rows) == len(groups)
    assert exact_dedup.exact_dedup(empty, digest_all=digest_all).count() == 0


ASSIGN = re.compile(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
RUN = re.compile("[A-Za-z0-9+/_=-]{20,}")
UUID = re.compile("(?<![0-9a-fA-F])[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}(?![0-9a-fA-F])")
HARMLESS = ("0123456789", "1234567890", "abcdefghij", "ABCDEFGHIJ")
PLACEHOLDERS = ("placeholder", "changeme", "redacted", "example", "sample", "dummy")


def _entropy(w):
    return -sum(c / len(w) * math.log2(c / len(w)) for c in (w.count(x) for x in set(w)))


def _spans(text):
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    for m in RUN.finditer(text):
        run, classes = m[0], {"a": re.search("[a-z]", m[0]), "A": re.search("[A-Z]", m[0]), "0": re.search("[0-9]", m[0])}
        if not (classes["a"] or classes["A"]) or not (classes["0"] or classes["a"] and classes["A"]):
            continue
        least = (3.0 if re.fullmatch("[0-9a-f]+|[0-9A-F]+", run) else 3.6 if not (classes["a"] and classes["A"]) else
                 3.9 if classes["0"] else 4.0)
        banned = [x.span() for x in UUID.finditer(run)]
        rest = UUID.sub(lambda x: " " * 36, run)
        for part in HARMLESS:
            banned += [x.span() for x in re.finditer(part, rest)]
            rest = rest.replace(part, " " * len(part))
        for part in PLACEHOLDERS:
            banned += [x.span() for x in re.finditer(part, rest.lower())]
            rest = re.sub(part, " " * len(part), rest, flags=re.IGNORECASE)
        hot = [i for i in range(len(run) - 19) if round(_entropy(run[i:i + 20]), 9) >= least and not any(a < i + 20 and i < b for a, b in banned)]
        if hot:
            out.append((m.start() + hot[0], 3, m.start() + hot[-1] + 20))
    return sorted(out)


def test_secrets(spark, empty):
    rng = random.Random(4)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    make = lambda n, a=letters: "".join(rng.choice(a) for _ in range(n))
    texts = ["", None, "nothing here", f'PassWord="{make(12)}" é {make(40)}', f"api_key : {make(5)}. token={make(9)}",
             f"AKIA{make(16, 'ABCDEF0123')} AKIA12 {make(64, '0123456789abcdef')}", "x" * 300 + make(900) + " " + make(30),
             "id 123e4567-e89b-12d3-a456-426614174000 and 0123456789abcdefghijklmnop", "tokenſ=abcdefgh Token='abc/def+gh=='",
             "🙂 secret=" + make(30) + "\nsecret = 'short' token: longenough", "9" * 40 + " " + make(24, "0123456789abcdef") * 3,
             " ".join(make(rng.randint(10, 60)) for _ in range(300)),
             f"SAMPLE_AUTH={make(36)} /example/{make(36)} {make(32, letters[:52])} key_{make(12)}_dummy_{make(30)}",
             f"id=123e4567-e89b-12d3-a456-426614174000&x={make(40)} someCamelCaseNameOfAThing A{'b' * 19} " + letters,
             " ".join(make(rng.randint(20, 300)) + rng.choice(PLACEHOLDERS) + make(rng.randint(0, 300)) for _ in range(40))]
    rows = [(i, t) for i, t in enumerate(texts)] + [(3, texts[3]), (None, texts[5])]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    got = secret_scan.secret_scan(df).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(i) for i, _ in rows)
    names = secret_scan.KINDS
    for r in got:
        found = _spans(dict(rows)[r.doc_id] or "")
        show = lambda s: ",".join(f"{names[k]}:{a}:{b}" for a, k, b in s)
        assert r.spans == show(found), r.doc_id
        base = [s for s in found if s[1] < 3]
        assert r.base_sha256 == hashlib.sha256(show(base).encode()).hexdigest()
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(s[1] == k for s in base) for k in range(3)]
    assert secret_scan.secret_scan(empty).count() == 0


def test_allow_listed_words_spare_only_what_they_stand_in(spark):
    rng = random.Random(9)
    key = "".join(rng.sample("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789", 36))
    letters = "".join(rng.sample("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz", 32))
    texts = [f"SAMPLE_AUTH={key}", f"/example/{key}", key, letters, "example" * 9, "x-123e4567-e89b-12d3-a456-426614174000"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    assert {r.doc_id: r.n_entropy for r in secret_scan.secret_scan(df).collect()} == {0: 1, 1: 1, 2: 1, 3: 1, 4: 0, 5: 0}
