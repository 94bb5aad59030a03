"""Property checks: the Spark coercions agree with the DataFrame-library
semantics the contracts were written against (pandas, public), on generated
text. Differences that are deliberate (date formats, overflow) are excluded
from the generators and documented in the README."""
import math

import pandas as pd
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from contractgate.functions import coerce as cz
from pyspark.sql import types as T

digits = st.text("0123456789", min_size=1, max_size=6)
number_like = st.one_of(
    st.builds(lambda s, a, b, e: f"{s}{a}{b}{e}",
              st.sampled_from(["", "+", "-"]), digits,
              st.sampled_from(["", ".", ".5", ".25"]),
              st.sampled_from(["", "e3", "E-2", "e+1"])),
    st.sampled_from(["inf", "-inf", "Infinity", "nan", "NaN", "5d", "5f", "0x10", "1,000", ".", "e5",
                     " 1 ", "1.", ".5", "+.5", "1_0", "", "abc", "1e", "--1", "1e400", "-1e400"]),
    st.text("0123456789.eE+- xa", max_size=8),
)


def spark_numbers(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, s string")
    out = df.select("i", F.expr(cz.to_number("s", T.StringType())).alias("d")).collect()
    return [r["d"] for r in sorted(out, key=lambda r: r["i"])]


@settings(max_examples=5, deadline=None)
@given(st.lists(number_like, min_size=20, max_size=60))
def test_number_parsing_matches_pandas(spark, values):
    got = spark_numbers(spark, values)
    ref = pd.to_numeric(pd.Series(values, dtype=object), errors="coerce")
    for v, g, r in zip(values, got, ref):
        r = float(r)
        if math.isnan(r):
            assert g is None, (v, g, r)
        else:
            assert g is not None and (g == r or math.isclose(g, r, rel_tol=1e-12)), (v, g, r)


tokens = st.sampled_from(["True", "False", "true", "false", "0", "1", "TRUE", "yes", "no", "t", "f", " 1", "1.0", ""])


@settings(max_examples=5, deadline=None)
@given(st.lists(tokens, min_size=10, max_size=40))
def test_boolean_tokens_match_isin(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, s string")
    got = [r["ok"] for r in sorted(df.select("i", F.expr(cz.boolean_token_ok("s", T.StringType())).alias("ok")).collect(),
                                   key=lambda r: r["i"])]
    ok = {True, False, "True", "False", "true", "false", 0, 1, "0", "1"}
    assert got == pd.Series(values, dtype=object).isin(ok).tolist()


@settings(max_examples=5, deadline=None)
@given(st.lists(st.sampled_from(["2024-03-15", "2024-3-5", "2020-02-30", "2024-13-01", "20240315", "2024/03/15",
                                 "03/15/2024", "15/03/2024", "2024-03-15 10:11:12", "2024-03-15T10:11:12",
                                 "2024", "2024-03", "garbage", "31/31/2024", "2023-02-29", "2024-02-29"]),
                min_size=5, max_size=30))
def test_date_parsing_matches_pandas_on_common_layouts(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, s string")
    got = [r["t"] for r in sorted(df.select("i", F.expr(cz.to_timestamp("s", T.StringType())).alias("t")).collect(),
                                  key=lambda r: r["i"])]
    import warnings
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        ref = [pd.to_datetime(pd.Series([v]), errors="coerce", format="mixed").iloc[0] for v in values]
    for v, g, r in zip(values, got, ref):
        if pd.isna(r):
            assert g is None, (v, g)
        else:
            assert g == r.to_pydatetime(), (v, g, r)
