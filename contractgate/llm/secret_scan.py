"""Secret scans: three fixed patterns, and high-entropy runs.

Fixed patterns (kinds ``assign``, ``access``, ``hex``) are matched leftmost and
non-overlapping over the whole text; matches that are too short are dropped.

Entropy (kind ``entropy``): candidates are runs of at least 20 characters of
``[A-Za-z0-9+/_=-]`` that hold a digit, or letters of both cases. A window of 20
characters slides over a candidate. It keeps the number of each character, of
which a step changes two (the one that leaves, the one that enters), and the
Shannon entropy that follows from them. A candidate is a secret when a
window reaches the threshold of the candidate's character class; its span goes
from the first to the last such window. Allow-listed parts of a candidate (UUIDs,
alphabets and number rows, placeholder words) are suppressed: no window
that touches one counts, whereas the rest of the candidate is scanned as usual.
The allow-list never touches the fixed patterns.

DataFrame functions only. The parts between the matches give the matches'
positions: their lengths are summed in a window over the document's own
matches, so one text is scanned once per kind and never compared by position
in a loop. Only lengths and spans are shuffled, keyed by document.

Defined cases: a null text is empty; empty texts have no spans (the digest is
that of the empty string); a repeated row gets the same result again; very long
runs are cut into overlapping chunks, so the work stays linear; a null doc_id
stays null; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import text_of


def _either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


# Fixed patterns; letters of the names in either case.
_NAMES = "|".join([*map(_either_case, ("password", "passwd", "secret", "token")), _either_case("api") + "_?" + _either_case("key")])
ASSIGN = rf"""({_NAMES})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = "AKIA[A-Z0-9]+"
HEX = "[0-9a-f]+"
LEAST = {"assign": 6, "access": 20, "hex": 24}
KINDS = ("assign", "access", "hex", "entropy")

WINDOW = 20
_CHUNK = 236  # window starts per chunk
CANDIDATE = (r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_=-]*[0-9]|[A-Z+/_=-]*[a-z][a-z+/_=-]*[A-Z]|[a-z+/_=-]*[A-Z][A-Z+/_=-]*[a-z])"
             r"[A-Za-z0-9+/_=-]{20,}")
# Least entropy (bits a character) of a window, by the class of the candidate.
# Names of two cases come near a random key's entropy, so letters alone have to reach more.
THRESHOLDS = {"hex": 3.0, "lower": 3.6, "letters": 4.0, "mixed": 3.9}
# Fixed allow-list. Candidates without letters are no secrets; of others these parts are none.
WITHOUT_LETTERS = r"^[0-9+/_=-]+$"
ALLOWED = (
    (r"(?<![0-9a-fA-F])[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}(?![0-9a-fA-F])", 36),
    *((part, len(part)) for part in ("0123456789", "1234567890", "abcdefghij", "ABCDEFGHIJ")),
    *((f"(?i){word}", len(word)) for word in ("placeholder", "changeme", "redacted", "example", "sample", "dummy")),
)
_BLANK = " "  # what an allow-listed part is overwritten with; no candidate holds one
_ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-" + _BLANK
_NONE = 64  # the count 0 as a character code; counts are kept as one character per letter of the alphabet


def _matches(kind: str, pattern: str) -> Column:
    """Array of (kind number, ordinal, characters before since the last match, characters, match)."""
    return F.transform(
        F.arrays_zip(F.transform(F.split(F.col("text"), pattern, -1), F.length).alias("gap"),
                     F.regexp_extract_all("text", F.lit(pattern), F.lit(0)).alias("hit")),
        lambda z, i: F.struct(F.lit(KINDS.index(kind)).alias("kind"), i.alias("nth"), z["gap"].cast("bigint").alias("gap"),
                              F.length(z["hit"]).cast("bigint").alias("chars"), z["hit"].alias("hit")))


def _c_log_c(count: Column) -> Column:
    return F.when(count > 0, count * F.log2(count.cast("double"))).otherwise(F.lit(0.0))


def _place(char: Column) -> Column:
    return F.instr(F.lit(_ALPHABET), char)


def _held(counts: Column, char: Column) -> Column:
    """How many of ``char`` the window holds."""
    return F.ascii(F.substr(counts, _place(char), F.lit(1))) - _NONE


def _with_count(counts: Column, char: Column, count: Column) -> Column:
    return F.overlay(counts, F.char(count + _NONE), _place(char), F.lit(1))


def _let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` worked out once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _hot_windows(chunk: Column, threshold: Column) -> Column:
    """(first, last) window start of a chunk whose entropy reaches the threshold; 0 if none does."""
    nothing = F.struct(F.lit(0.0).alias("s"), F.lit(chr(_NONE) * len(_ALPHABET)).alias("counts"))

    def enter(acc: Column, char: Column) -> Column:
        return _let(_held(acc["counts"], char), lambda n: F.struct(
            (acc["s"] - _c_log_c(n) + _c_log_c(n + 1)).alias("s"), _with_count(acc["counts"], char, n + 1).alias("counts")))

    def leave(acc: Column, char: Column) -> Column:
        return _let(_held(acc["counts"], char), lambda n: F.struct(
            (acc["s"] - _c_log_c(n) + _c_log_c(n - 1)).alias("s"), _with_count(acc["counts"], char, n - 1).alias("counts")))

    def judged(window: Column, i: Column, first: Column, last: Column) -> Column:
        high = F.round(F.log2(F.lit(float(WINDOW))) - window["s"] / WINDOW, 9) >= threshold
        return _let(high & (_held(window["counts"], F.lit(_BLANK)) == 0), lambda hit: F.struct(
            window["s"].alias("s"), window["counts"].alias("counts"),
            F.when(hit & (first == 0), i).otherwise(first).alias("first"), F.when(hit, i).otherwise(last).alias("last")))

    def slide(acc: Column, i: Column) -> Column:
        gone, come = F.substr(chunk, i - 1, F.lit(1)), F.substr(chunk, i + (WINDOW - 1), F.lit(1))
        return _let(leave(acc, gone), lambda w: _let(enter(w, come), lambda x: judged(x, i, acc["first"], acc["last"])))

    opening = F.aggregate(F.split(F.substring(chunk, 1, WINDOW), ""), nothing, enter)
    zero = _let(opening, lambda w: judged(w, F.lit(1), F.lit(0), F.lit(0)))
    steps = F.when(F.length(chunk) > WINDOW, F.sequence(F.lit(2), F.length(chunk) - (WINDOW - 1))).otherwise(F.array().cast("array<int>"))
    return F.aggregate(steps, zero, slide)


def _hot_span(run: Column) -> Column:
    """(from, to) offsets of the hot part of a candidate; null if it has none."""
    threshold = (F.when(run.rlike("^([0-9a-f]+|[0-9A-F]+)$"), F.lit(THRESHOLDS["hex"]))
                 .when(run.rlike("[a-z]") & run.rlike("[A-Z]"), F.when(run.rlike("[0-9]"), F.lit(THRESHOLDS["mixed"])).otherwise(F.lit(THRESHOLDS["letters"])))
                 .otherwise(F.lit(THRESHOLDS["lower"])))
    scanned = run
    for pattern, length in ALLOWED:
        scanned = F.regexp_replace(scanned, pattern, _BLANK * length)
    chunks = F.regexp_extract_all(scanned, F.lit(f".{{1,{_CHUNK}}}"), F.lit(0))
    # each chunk with the start of the next one, so that every window stands in one chunk
    tails = F.concat(F.slice(F.transform(chunks, lambda c: F.substring(c, 1, WINDOW - 1)), 2, 1 << 30), F.array(F.lit("")))
    found = F.transform(F.zip_with(chunks, tails, lambda c, t: F.concat(c, t)),
                        lambda c, k: F.when(F.length(c) >= WINDOW, F.struct(_hot_windows(c, threshold).alias("w"), (k * _CHUNK).alias("at"))))
    hot = F.filter(found, lambda x: x.isNotNull() & (x["w"]["first"] > 0))
    return F.when(F.size(hot) > 0, F.struct(
        F.array_min(F.transform(hot, lambda x: x["at"] + x["w"]["first"] - 1)).cast("bigint").alias("lo"),
        F.array_max(F.transform(hot, lambda x: x["at"] + x["w"]["last"] - 1 + WINDOW)).cast("bigint").alias("hi")))


def _judge() -> Column:
    """(lo, hi) offsets of a match's span within the match; null if it fails."""
    hit, kind = F.col("m.hit"), F.col("m.kind")
    all_of_it = F.struct(F.lit(0).cast("bigint").alias("lo"), F.length(hit).cast("bigint").alias("hi"))
    return (F.when((kind == 0) & (F.length(F.regexp_extract(hit, ASSIGN, 2)) >= LEAST["assign"]), all_of_it)
            .when((kind == 1) & (F.length(hit) >= LEAST["access"]), all_of_it)
            .when((kind == 2) & (F.length(hit) >= LEAST["hex"]), all_of_it)
            .when((kind == 3) & ~hit.rlike(WITHOUT_LETTERS), _hot_span(hit)))


def _joined(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def secret_scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_entropy for every row."""
    # `hex` runs shorter than needed are not even split at: a run is maximal, so asking for 24 characters drops the same ones
    patterns = {"assign": ASSIGN, "access": ACCESS, "hex": "[0-9a-f]{24,}", "entropy": CANDIDATE}
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_of().alias("text"))
    here = F.array(F.struct(F.lit(-1).alias("kind"), F.lit(0).alias("nth"), F.lit(0).cast("bigint").alias("gap"),
                            F.lit(0).cast("bigint").alias("chars"), F.lit("").alias("hit")))
    found = rows.select("doc_id", F.xxhash64("doc_id", "text").alias("h"), F.explode(F.concat(
        here, *[F.filter(_matches(k, p), lambda m: m["hit"].isNotNull()) for k, p in patterns.items()])).alias("m"))
    judged = found.select("doc_id", "h", F.col("m.kind").alias("kind"), F.col("m.nth").alias("nth"), F.col("m.gap").alias("gap"),
                          F.col("m.chars").alias("chars"), _judge().alias("span"))
    # one exchange: documents, then their matches (a repeated row's are the same), then sums over them
    item = F.struct("kind", "nth", "gap", "chars", "span")
    by_doc = judged.groupBy("doc_id", "h").agg(
        F.collect_set(F.when(F.col("kind") >= 0, item)).alias("items"), F.sum(F.when(F.col("kind") < 0, 1).otherwise(0)).alias("copies"))
    each = by_doc.select("doc_id", "h", "copies", F.explode_outer("items").alias("i"))
    own = Window.partitionBy("doc_id", "h", "i.kind").orderBy("i.nth")
    start = F.sum(F.col("i.gap") + F.col("i.chars")).over(own) - F.col("i.chars")
    placed = each.withColumn("start", start)
    span = F.struct((F.col("start") + F.col("i.span.lo")).alias("start"), F.col("i.kind").alias("kind"),
                    (F.col("start") + F.col("i.span.hi")).alias("end"))
    spans = placed.groupBy("doc_id", "h").agg(
        F.first("copies").alias("copies"), F.collect_list(F.when(F.col("i.span").isNotNull(), span)).alias("all"))
    base = F.filter("all", lambda s: s["kind"] < 3)
    number = lambda k: F.size(F.filter("all", lambda s: s["kind"] == k)).cast("bigint")
    out = spans.select("doc_id", *[number(k).alias(f"n_{name}") for k, name in enumerate(KINDS[:3])],
                       F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("all")).alias("spans"),
                       number(3).alias("n_entropy"), F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"))
    return out.drop("copy")
