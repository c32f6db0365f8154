"""Scalar, array and matrix functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from harborline.functions import arrays, scalars
from harborline.functions.calendar import calendar_columns
from harborline.plans.aggregate_queries import r
from harborline.plans.registry import query
from harborline.plans.tables import table

_CALENDAR = """CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month, CAST(day(d) AS INTEGER) AS day, CAST(isodow(d) - 1 AS INTEGER) AS dayofweek,
  CAST(dayofyear(d) AS INTEGER) AS dayofyear, CAST(week(d) AS INTEGER) AS weekofyear, CAST(quarter(d) AS INTEGER) AS quarter, CAST(isodow(d) >= 6 AS INTEGER) AS is_weekend,
  CAST(day(d) = 1 AS INTEGER) AS is_month_start, CAST(d = last_day(d) AS INTEGER) AS is_month_end,
  CAST(day(d) = 1 AND month(d) IN (1, 4, 7, 10) AS INTEGER) AS is_quarter_start, CAST(d = last_day(d) AND month(d) IN (3, 6, 9, 12) AS INTEGER) AS is_quarter_end"""
_CALENDAR_NAMES = (
    "year month day dayofweek dayofyear weekofyear quarter is_weekend is_month_start is_month_end is_quarter_start is_quarter_end"
).split()


@query("calendar_features", f"WITH days AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders) SELECT o_orderkey, {_CALENDAR} FROM days")
def _(spark, sf):
    columns = calendar_columns(F.to_date("o_orderdate"))
    return table(spark, sf, "orders").select("o_orderkey", *[columns[n].alias(n) for n in _CALENDAR_NAMES])


@query(
    "cyclical_encoding",
    """SELECT o_orderkey, round(sin(2 * pi() * month(o_orderdate) / 12), 10) + 0.0 AS month_sin, round(cos(2 * pi() * month(o_orderdate) / 12), 10) + 0.0 AS month_cos,
       round(sin(2 * pi() * (isodow(o_orderdate) - 1) / 7), 10) + 0.0 AS dayofweek_sin, round(cos(2 * pi() * (isodow(o_orderdate) - 1) / 7), 10) + 0.0 AS dayofweek_cos FROM orders""",
)
def _(spark, sf):
    columns = calendar_columns(F.to_date("o_orderdate"))
    names = ("month_sin", "month_cos", "dayofweek_sin", "dayofweek_cos")
    return table(spark, sf, "orders").select("o_orderkey", *[(F.round(columns[n], 10) + F.lit(0.0)).alias(n) for n in names])


@query(
    "date_format",
    "SELECT o_orderkey, strftime(o_orderdate, '%d-%m-%Y') AS day_first, strftime(o_orderdate, '%m/%d/%Y') AS month_first, strftime(o_orderdate, '%Y-%m') AS period FROM orders",
)
def _(spark, sf):
    d = F.col("o_orderdate")
    return table(spark, sf, "orders").select(
        "o_orderkey",
        F.date_format(d, "dd-MM-yyyy").alias("day_first"),
        F.date_format(d, "MM/dd/yyyy").alias("month_first"),
        F.date_format(d, "yyyy-MM").alias("period"),
    )


@query("date_parts_time", "SELECT event_id, CAST(hour(ts) AS INTEGER) AS hour, CAST(minute(ts) AS INTEGER) AS minute, CAST(second(ts) AS INTEGER) AS second FROM events")
def _(spark, sf):
    return table(spark, sf, "events").select("event_id", *[f("ts").alias(n) for n, f in (("hour", F.hour), ("minute", F.minute), ("second", F.second))])


@query(
    "date_shift",
    "SELECT event_id, CAST(ts AS DATE) AS day, CAST(ts AS DATE) - 28 AS before, CAST(ts AS DATE) + 7 AS after, date_trunc('day', ts) AS midnight FROM events",
)
def _(spark, sf):
    day = F.to_date("ts")
    return table(spark, sf, "events").select(
        "event_id", day.alias("day"), F.date_sub(day, 28).alias("before"), F.date_add(day, 7).alias("after"), F.date_trunc("day", "ts").alias("midnight")
    )


@query("string_case", "SELECT p_partkey, upper(p_name) AS upper_name, lower(p_type) AS lower_type FROM part")
def _(spark, sf):
    return table(spark, sf, "part").select("p_partkey", F.upper("p_name").alias("upper_name"), F.lower("p_type").alias("lower_type"))


@query("string_pad_concat", "SELECT o_orderkey, concat(CAST(year(o_orderdate) AS VARCHAR), '-', lpad(CAST(month(o_orderdate) AS VARCHAR), 2, '0')) AS month_year FROM orders")
def _(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", scalars.year_month(F.year("o_orderdate"), F.month("o_orderdate")).alias("month_year"))


@query("string_contains", "SELECT doc_id, contains(source, 'src1') AS hit, contains(text, lang) AS has_lang FROM documents")
def _(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id", F.contains("source", F.lit("src1")).alias("hit"), F.contains("text", "lang").alias("has_lang")
    )


@query(
    "math_elementwise",
    """SELECT l_orderkey, l_linenumber, round(l_quantity + l_tax, 6) AS added, round(l_quantity - l_tax, 6) AS subtracted, round(l_quantity * l_tax, 6) AS multiplied,
       round(l_tax / l_quantity, 8) AS divided, pow(l_quantity, 2) AS squared, round(sqrt(l_quantity), 8) AS root, round(exp(l_discount), 8) AS exponential,
       round(ln(l_quantity), 8) AS logarithm, round(sin(l_quantity), 8) AS sine, round(cos(l_quantity), 8) AS cosine, abs(-l_quantity) AS magnitude FROM lineitem""",
)
def _(spark, sf):
    q, t = F.col("l_quantity"), F.col("l_tax")
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", r(q + t, 6, "added"), r(q - t, 6, "subtracted"), r(q * t, 6, "multiplied"), r(t / q, 8, "divided"),
        F.pow(q, 2).alias("squared"), r(F.sqrt(q), 8, "root"), r(F.exp("l_discount"), 8, "exponential"), r(F.log(q), 8, "logarithm"),
        r(F.sin(q), 8, "sine"), r(F.cos(q), 8, "cosine"), F.abs(-q).alias("magnitude"),
    )


@query(
    "broadcast_vector",
    """WITH m AS (SELECT i, avg(v) AS mean FROM (SELECT CAST(unnest(embedding) AS DOUBLE) AS v, unnest(generate_series(1, len(embedding))) AS i FROM embeddings) GROUP BY 1)
       SELECT vec_id, i AS position, round(v + mean, 6) AS shifted FROM (SELECT vec_id, CAST(unnest(embedding) AS DOUBLE) AS v, unnest(generate_series(1, len(embedding))) AS i FROM embeddings) JOIN m USING (i)""",
)
def _(spark, sf):
    # The row vector is the mean embedding: one aggregate row, added to every row's array.
    df = table(spark, sf, "embeddings").select("vec_id", "embedding")
    means = (
        df.select(F.posexplode("embedding").alias("i", "v")).groupBy("i").agg(F.avg(F.col("v").cast("double")).alias("mean"))
        .agg(F.transform(F.sort_array(F.collect_list(F.struct("i", "mean"))), lambda s: s["mean"]).alias("m"))
    )
    shifted = df.withColumn("m", means.scalar()).select(
        "vec_id", arrays.add_vector(F.col("embedding"), F.col("m")).alias("shifted")
    )
    return shifted.select("vec_id", F.posexplode("shifted").alias("p", "s")).select(
        "vec_id", (F.col("p") + 1).cast("long").alias("position"), r("s", 6, "shifted")
    )


@query(
    "array_build",
    """SELECT p_partkey, CAST(list_sum(range(0, p_size + 1)) AS BIGINT) AS arange_sum, round(list_sum(list_transform(range(0, 5), lambda i: 0.0 + p_size * i / 4.0)), 6) AS linspace_sum,
       round(list_sum(list_transform(range(0, 3), lambda i: pow(10.0, i * 1.0))), 6) AS logspace_sum, 2 * p_size + p_partkey * 2 AS repeat_sum, 3 * (p_size + p_partkey) AS tile_sum, p_size AS repeat_second FROM part""",
)
def _(spark, sf):
    size = F.col("p_size").cast("double")
    pair = F.array(F.col("p_size").cast("long"), F.col("p_partkey"))
    plain = lambda a: F.aggregate(a, F.lit(0).cast("long"), lambda s, x: s + x)
    return table(spark, sf, "part").select(
        "p_partkey",
        plain(F.sequence(F.lit(0).cast("long"), F.col("p_size").cast("long"))).alias("arange_sum"),
        r(arrays.total(arrays.linspace(F.lit(0.0), size, 5)), 6, "linspace_sum"),
        r(arrays.total(arrays.logspace(F.lit(0.0), F.lit(2.0), 3)), 6, "logspace_sum"),
        plain(arrays.repeat_each(pair, 2)).alias("repeat_sum"),
        plain(arrays.tile(pair, 3)).alias("tile_sum"),
        F.element_at(arrays.repeat_each(pair, 2), 2).cast("int").alias("repeat_second"),
    )


@query(
    "array_manip",
    """SELECT vec_id, 2 * len(embedding) AS concat_size, round(list_sum(list_transform(embedding[1:16], lambda x: CAST(x AS DOUBLE))), 6) AS first_part,
       round(list_sum(list_transform(embedding[49:64], lambda x: CAST(x AS DOUBLE))), 6) AS last_part, CAST(embedding[20] AS DOUBLE) AS ravelled FROM embeddings""",
)
def _(spark, sf):
    e = F.col("embedding")
    parts = arrays.split_equal(e, 4, 64)
    return table(spark, sf, "embeddings").select(
        "vec_id",
        F.size(F.concat(e, e)).cast("long").alias("concat_size"),
        r(arrays.total(F.element_at(parts, 1)), 6, "first_part"),
        r(arrays.total(F.element_at(parts, -1)), 6, "last_part"),
        F.element_at(F.flatten(parts), 20).cast("double").alias("ravelled"),
    )


@query(
    "array_coords",
    """SELECT p_partkey, x, y FROM (SELECT p_partkey, p_size, CAST(unnest(range(1, p_size + 1)) AS INTEGER) AS x FROM part), (SELECT CAST(unnest(range(0, 3)) AS INTEGER) AS y)""",
)
def _(spark, sf):
    df = table(spark, sf, "part").select(
        "p_partkey", F.sequence(F.lit(1), F.col("p_size")).alias("xs"), F.array(F.lit(0), F.lit(1), F.lit(2)).alias("ys")
    )
    return arrays.mesh(df, "xs", "ys")


@query("dot_product", "SELECT vec_id, round(list_dot_product(list_transform(embedding, lambda x: CAST(x AS DOUBLE)), list_transform(list_reverse(embedding), lambda x: CAST(x AS DOUBLE))), 8) AS dot FROM embeddings")
def _(spark, sf):
    e = F.col("embedding")
    return table(spark, sf, "embeddings").select("vec_id", r(arrays.dot(e, F.reverse(e)), 8, "dot"))


_A = "a AS (SELECT c_nationkey AS i, year(o_orderdate) * 12 + month(o_orderdate) AS k, round(sum(o_totalprice), 2) AS v FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2)"
_B = "b AS (SELECT year(l_shipdate) * 12 + month(l_shipdate) AS k, l_linenumber AS j, count(*) AS v FROM lineitem GROUP BY 1, 2)"


def _matrices(spark, sf):
    """Nation x month amounts and month x line number counts."""
    customer = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    month = lambda d: F.year(d) * 12 + F.month(d)
    a = (
        table(spark, sf, "orders").join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy(F.col("c_nationkey").alias("i"), month("o_orderdate").alias("j")).agg(r(F.sum("o_totalprice"), 2, "v"))
    )
    b = table(spark, sf, "lineitem").groupBy(month("l_shipdate").alias("i"), F.col("l_linenumber").alias("j")).agg(F.count(F.lit(1)).alias("v"))
    return a, b


@query("matrix_multiply", f"WITH {_A}, {_B} SELECT CAST(i AS BIGINT) AS i, CAST(j AS BIGINT) AS j, round(sum(a.v * b.v), 2) AS v FROM a JOIN b USING (k) GROUP BY 1, 2")
def _(spark, sf):
    return arrays.multiply(*_matrices(spark, sf)).select("i", "j", r("v", 2))


@query("matrix_transpose", f"WITH {_A} SELECT CAST(k AS INTEGER) AS i, i AS j, v FROM a")
def _(spark, sf):
    return arrays.transpose(_matrices(spark, sf)[0])


@query(
    "json_parse_safe",
    """SELECT event_id, CASE WHEN event_type = 'error' THEN NULL ELSE CAST(json_extract(props, '$.k') AS BIGINT) END AS k FROM events""",
)
def _(spark, sf):
    # Error events carry their whole text behind a stray character, so that it isn't valid JSON.
    text = F.when(F.col("event_type") == "error", F.concat(F.lit("x"), "props")).otherwise(F.col("props"))
    return table(spark, sf, "events").select("event_id", scalars.parse_json(text, "k long")["k"].alias("k"))


_U = "CAST(CAST('0x' || substr(md5(concat_ws('|', {})), 1, 13) AS BIGINT) AS DOUBLE) / 4503599627370496.0"


@query(
    "seeded_random",
    f"""WITH u AS (SELECT o_orderkey, {_U.format("'7', CAST(o_orderkey AS VARCHAR)")} AS uniform, {_U.format("'7', CAST(o_orderkey AS VARCHAR), 'u'")} AS a, {_U.format("'7', CAST(o_orderkey AS VARCHAR), 'v'")} AS b FROM orders)
        SELECT o_orderkey, uniform, round(sqrt(-2 * ln(1 - a)) * cos(2 * pi() * b), 10) AS normal, uniform < 0.2 AS sampled FROM u""",
)
def _(spark, sf):
    key = F.col("o_orderkey")
    return table(spark, sf, "orders").select(
        "o_orderkey",
        scalars.keyed_uniform(7, key).alias("uniform"),
        r(scalars.keyed_normal(7, key), 10, "normal"),
        scalars.keyed_sample(7, 0.2, key).alias("sampled"),
    )


@query(
    "density_score",
    """WITH s AS (SELECT avg(c_acctbal) AS m, stddev_pop(c_acctbal) AS s, min(c_acctbal) AS lo, max(c_acctbal) AS hi FROM customer),
       z AS (SELECT c_custkey, c_acctbal AS x, m, s, lo, hi, (c_acctbal - m) / (s * sqrt(2)) AS z FROM customer, s)
       SELECT c_custkey, round(exp(-z * z) / (s * sqrt(2 * pi())), 12) AS normal_pdf,
         round((1 + 2 / sqrt(pi()) * list_sum(list_transform(range(0, 60), lambda n: (CASE WHEN n % 2 = 0 THEN 1 ELSE -1 END) * pow(z, 2 * n + 1) / (exp(lgamma(n + 1)) * (2 * n + 1))))) / 2, 8) AS normal_cdf,
         round(1 / (hi - lo), 12) AS uniform_pdf, round((x - lo) / (hi - lo), 8) AS uniform_cdf FROM z""",
)
def _(spark, sf):
    df = table(spark, sf, "customer").select("c_custkey", F.col("c_acctbal").alias("x"))
    s = df.agg(F.avg("x").alias("m"), F.stddev_pop("x").alias("s"), F.min("x").alias("lo"), F.max("x").alias("hi"))
    m, sd, lo, hi = (s.select(c).scalar() for c in ("m", "s", "lo", "hi"))
    x = F.col("x")
    return df.select(
        "c_custkey",
        r(scalars.normal_pdf(x, m, sd), 12, "normal_pdf"),
        r(scalars.normal_cdf(x, m, sd), 8, "normal_cdf"),
        r(scalars.uniform_pdf(x, lo, hi), 12, "uniform_pdf"),
        r(scalars.uniform_cdf(x, lo, hi), 8, "uniform_cdf"),
    )
