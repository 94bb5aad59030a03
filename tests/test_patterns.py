"""Python patterns as Spark runs them, against ``re.match`` itself."""
import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from contractgate.functions.patterns import java_pattern
from contractgate.operators.contract import Contract, lint_contract
from contractgate.operators.validate import validate

PATTERNS = [
    r"(?P<n>a)bc", r"a{,3}b", r"abc\Z", r"[a&&b]", r"^abc$", r"(?m)^b$", r"(?s)a.c", r"a.c", r"\d+$", r"\w+\b", r"\B.", r"[^\W\d]+$",
    r"[\D]x", r"[^\Sx]", r"(?i)straße|kK", r"(?i)[i-k]+$", r"(?x) a  b # note", r"(a)(b)?\2c", r"(?P<q>['\"]).*?(?P=q)$", r"(?:ab|a)(?>bc|b)c",
    r"a++b", r"a*?b$", r"(?<=a)b|ab(?!c)", r"\s+$", r"[]x-]+$", r"[[a]+", r"\x41\u00e9\N{DIGIT ONE}", r"(?a:\w+)$", r"(?-i:a)b", r"{,}", r"a{2}", r"x{0,0}$",
    r"#", r"\Aab\Z", r"(|a)+$", r"(?=a)*b", r"[\w.-]+@[\w-]+\.\w{2,}$", r"CUST_\d{8}$", r"\.\*\+\?", r"[a~~b--c||d]+$", r"\Q", r"(?!)", r"", r"[\d-x]+$",
]
TEXTS = ["abc", "abc\n", "x1", "a", "b", "ab", "aab", "aaab", "bc", "abcc", "a\nb", "a\nc", "a\rc", "a\u2028c", "12", "١٢", "12\n", "é1", "straße", "STRAßE", "Kk", "İıJ", "ijK",
         "&", "[", "x", "]-x", "'q'", "\"q\"x", "aba", "ac", "\x1c\x85", " \t\u3000", "Aé1", "a.b@c-d.ef", "CUST_00000001", ".*+?", "b--c||", "", "_", "ſ", "²", "\n", "a b", "#", "{,}", "\U0001d4b3x", "~~"]


def _spark_matches(spark, patterns, texts):
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    literals = ["'" + java_pattern(p).replace("\\", "\\\\").replace("'", "\\'") + "'" for p in patterns]
    rows = frame.selectExpr("i", *[f"t RLIKE {p} AS p{k}" for k, p in enumerate(literals)]).collect()
    return {(k, r.i): r[f"p{k}"] for r in rows for k in range(len(patterns))}


def test_patterns_accept_what_python_accepts(spark):
    patterns = [p for p in PATTERNS if _valid(p)]
    assert len(patterns) >= 40
    got = _spark_matches(spark, patterns, TEXTS)
    wrong = [(p, t) for k, p in enumerate(patterns) for i, t in enumerate(TEXTS) if got[k, i] != bool(re.match(p, t))]
    assert wrong == []


def _valid(p):
    try:
        re.compile(p)
        return True
    except re.error:
        return False


ATOM = st.sampled_from(["a", "b", "B", "é", "1", ".", r"\d", r"\W", r"\s", r"\b", r"\B", "^", "$", r"\Z", "[ab]", "[^a1]", r"[\d_]", r"[^\w]", "[a-]", "&&", "-", "#", r"\.", "[&&a]", "K"])
PIECE = st.recursive(ATOM, lambda inner: st.one_of(
    st.lists(inner, min_size=1, max_size=3).map("".join),
    st.tuples(inner, inner).map(lambda x: f"({x[0]}|{x[1]})"),
    st.tuples(inner, st.sampled_from(["*", "+", "?", "{,2}", "{1,3}", "*?", "+?", "{2}"])).map(lambda x: f"(?:{x[0]}){x[1]}"),
    inner.map(lambda x: f"(?={x})"), inner.map(lambda x: f"(?!{x})"), inner.map(lambda x: f"(?P<g>{x})" if "?P" not in x else x),
    inner.map(lambda x: f"(?i:{x})"), inner.map(lambda x: f"(?ms:{x})"), inner.map(lambda x: f"(?a:{x})")), max_leaves=6)


@settings(max_examples=25, deadline=None, suppress_health_check=list(HealthCheck))
@given(patterns=st.lists(PIECE, min_size=12, max_size=12), texts=st.lists(st.text("abB1é_ \n-&#.Kk\u212a", max_size=6), min_size=12, max_size=12))
def test_generated_patterns_accept_what_python_accepts(spark, patterns, texts):
    patterns = [p for p in patterns if _valid(p)]
    got = _spark_matches(spark, patterns, texts)
    wrong = [(p, t) for k, p in enumerate(patterns) for i, t in enumerate(texts) if got[k, i] != bool(re.match(p, t))]
    assert wrong == []


@pytest.mark.parametrize("pattern", [r"(a)?(?(1)b|c)", r"(?i)(a)\1", "a{99999999999}", "(", "\ud800"])
def test_what_has_no_equal_is_refused_when_linted(pattern):
    contract = Contract.from_dict({"entity": "e", "version": "1", "columns": [{"name": "c", "pattern": pattern}]})
    assert any("pattern" in p for p in lint_contract(contract))


def test_pattern_rule_counts_as_python_does(spark):
    rows = spark.createDataFrame([(t,) for t in ("abc", "abc\n", "x1", "aab", "&")], "c string")
    for pattern in (r"abc\Z", "[a&&b]", "(?P<n>a)bc", "a{,3}b"):
        contract = Contract.from_dict({"entity": "e", "version": "1", "columns": [{"name": "c", "pattern": pattern}]})
        failing = sum(v.failing_rows for v in validate(rows, contract).violations.collect())
        assert failing == sum(not re.match(pattern, t) for t in ("abc", "abc\n", "x1", "aab", "&")), pattern
