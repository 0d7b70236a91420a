"""Text, date, number and array functions over whole columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import query, table
from fieldbook.functions import text, values

# The long texts are compared by hash, after the function ran over the whole text.


def _documents(spark, sf):
    return table(spark, sf, "documents").select("doc_id", "text")


@query("case_functions", "F3", "SELECT doc_id, md5(upper(replace(text, 'ß', 'SS'))) AS upper, md5(lower(text)) AS lower FROM documents")
def case_functions(spark, sf):
    return _documents(spark, sf).select("doc_id", F.md5(F.upper("text")).alias("upper"), F.md5(F.lower("text")).alias("lower"))


@query("swap_case", "F4", """SELECT doc_id, md5(translate(text, 'abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz')) AS swapped FROM documents""")
def swap_case(spark, sf):
    return _documents(spark, sf).select("doc_id", F.md5(text.swap_case(F.col("text"))).alias("swapped"))


@query("literal_replace", "F5", "SELECT doc_id, md5(replace(text, ' the', ' THE')) AS replaced FROM documents")
def literal_replace(spark, sf):
    return _documents(spark, sf).select("doc_id", F.md5(F.replace("text", F.lit(" the"), F.lit(" THE"))).alias("replaced"))


@query("pattern_replace", "F2", "SELECT doc_id, md5(regexp_replace(regexp_replace(text, '[ \\t\\n\\r\\f]+', '_', 'g'), '[^A-Za-z0-9_]', '', 'g')) AS name FROM documents")
def pattern_replace(spark, sf):
    joined = F.regexp_replace(F.regexp_replace("text", r"[ \t\n\r\f]+", "_"), "[^A-Za-z0-9_]", "")
    return _documents(spark, sf).select("doc_id", F.md5(joined).alias("name"))


@query("title_case", "F6", """SELECT doc_id, md5(array_to_string(list_transform(regexp_extract_all(lower(text), '\\p{L}+|\\P{L}+'),
    lambda w: CASE WHEN w[1] = 'ß' THEN 'Ss' ELSE upper(w[1]) END || w[2:]), '')) AS titled FROM documents""")
def title_case(spark, sf):
    return _documents(spark, sf).select("doc_id", F.md5(text.title_case(F.col("text"))).alias("titled"))


@query("reverse_text", "F7", "SELECT p_partkey, reverse(p_name) AS reversed FROM part")
def reverse_text(spark, sf):
    return table(spark, sf, "part").select("p_partkey", F.reverse("p_name").alias("reversed"))


@query("reverse_words", "F8", "SELECT p_partkey, array_to_string(list_reverse(string_split(p_name, ' ')), ' ') AS reversed FROM part")
def reverse_words(spark, sf):
    return table(spark, sf, "part").select("p_partkey", text.reverse_words(F.col("p_name")).alias("reversed"))


@query("split_and_join", "F9", "SELECT o_orderkey, array_to_string(string_split(o_orderpriority, '-'), '/') AS joined, len(string_split(o_orderpriority, '-'))::INT AS parts FROM orders")
def split_and_join(spark, sf):
    parts = F.split("o_orderpriority", "-")
    return table(spark, sf, "orders").select("o_orderkey", F.array_join(parts, "/").alias("joined"), F.size(parts).alias("parts"))


@query("swap_pairs", "F10", "SELECT doc_id, md5(regexp_replace(text, '(?s)(.)(.)', '\\2\\1', 'g')) AS swapped FROM documents")
def swap_pairs(spark, sf):
    return _documents(spark, sf).select("doc_id", F.md5(text.swap_pairs(F.col("text"))).alias("swapped"))


@query("interchange_characters", "F11", """SELECT p_partkey, CASE WHEN len(p_name) > 4 THEN p_name[1] || p_name[5] || p_name[3:4] || p_name[2] || p_name[6:]
    ELSE p_name END AS swapped FROM part""")
def interchange_characters(spark, sf):
    return table(spark, sf, "part").select("p_partkey", text.interchange(F.col("p_name"), 1, 4).alias("swapped"))


@query("classify_tokens", "F12", """WITH t AS (SELECT doc_id, string_split_regex(regexp_replace(regexp_replace(text, '^\\s+', ''), '\\s+$', ''), '\\s+') AS w FROM documents),
    n AS (SELECT doc_id, list_filter(w, lambda x: regexp_full_match(x, '[0-9]+')) AS d, list_filter(w, lambda x: regexp_full_match(x, '\\p{L}+')) AS a FROM t)
    SELECT doc_id, len(d)::INT AS numbers, len(a)::INT AS words, list_max(list_transform(d, lambda x: try_cast(x AS HUGEINT)))::VARCHAR AS largest FROM n""")
def classify_tokens(spark, sf):
    numbers = text.integer_tokens(F.col("text"))
    return _documents(spark, sf).select(
        "doc_id", F.size(numbers).alias("numbers"), F.size(text.letter_tokens(F.col("text"))).alias("words"),
        F.array_max(numbers).cast("string").alias("largest"),
    )


@query("format_values", "F13", "SELECT o_orderkey, printf('%s/%d', o_orderstatus, o_custkey) AS label, format('{:,}', floor(o_totalprice)::BIGINT) AS price FROM orders")
def format_values(spark, sf):
    from fieldbook.functions.formatting import count_text

    return table(spark, sf, "orders").select(
        "o_orderkey", F.format_string("%s/%d", "o_orderstatus", "o_custkey").alias("label"),
        count_text(F.floor("o_totalprice")).alias("price"),
    )


@query("date_parts", "F15 F17", """SELECT o_orderkey, year(o_orderdate)::INT AS year, month(o_orderdate)::INT AS month, (isodow(o_orderdate) - 1)::INT AS weekday,
    quarter(o_orderdate)::INT AS quarter, strftime(o_orderdate, '%b') AS month_name, strftime(o_orderdate, '%a') AS day_name FROM orders""")
def date_parts(spark, sf):
    d = "o_orderdate"
    return table(spark, sf, "orders").select(
        "o_orderkey", F.year(d).alias("year"), F.month(d).alias("month"), F.weekday(d).alias("weekday"),
        F.quarter(d).alias("quarter"), F.date_format(d, "MMM").alias("month_name"), F.date_format(d, "E").alias("day_name"),
    )


@query("day_differences", "F16", """SELECT l_orderkey, l_linenumber, date_diff('day', o_orderdate::DATE, l_shipdate::DATE)::INT AS days,
    floor((epoch_us(l_shipdate) - epoch_us(o_orderdate)) / 86400000000.0::DOUBLE)::BIGINT AS whole_days FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")
def day_differences(spark, sf):
    li, o = table(spark, sf, "lineitem"), table(spark, sf, "orders")
    return li.join(o, li.l_orderkey == o.o_orderkey).select(
        "l_orderkey", "l_linenumber", F.datediff("l_shipdate", "o_orderdate").alias("days"),
        values.whole_days(F.col("o_orderdate"), F.col("l_shipdate")).alias("whole_days"),
    )


@query("truncated_dates", "F18", "SELECT strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS month, count(*) AS n FROM orders GROUP BY 1")
def truncated_dates(spark, sf):
    month = F.date_format(F.date_trunc("month", "o_orderdate"), "yyyy-MM-dd").alias("month")
    return table(spark, sf, "orders").groupBy(month).agg(F.count("*").alias("n"))


@query("number_functions", "F19", "SELECT c_custkey, abs(c_acctbal) AS size, round(ln(1 + abs(c_acctbal)), 8) AS logged, round_even(c_acctbal, 0) AS whole FROM customer")
def number_functions(spark, sf):
    b = F.col("c_acctbal")
    return table(spark, sf, "customer").select(
        "c_custkey", F.abs(b).alias("size"), F.round(F.log1p(F.abs(b)), 8).alias("logged"), F.bround(b, 0).alias("whole")
    )


@query("lookup_default", "F20", """SELECT c_custkey, coalesce(n, 0) AS n FROM customer LEFT JOIN
    (SELECT o_custkey, count(*) AS n FROM orders WHERE o_totalprice > 400000 GROUP BY 1) ON c_custkey = o_custkey""")
def lookup_default(spark, sf):
    n = table(spark, sf, "orders").filter("o_totalprice > 400000").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n"))
    return table(spark, sf, "customer").join(n, "c_custkey", "left").select("c_custkey", F.coalesce("n", F.lit(0)).alias("n"))


@query("grade_bands", "F21", """SELECT o_orderkey, CASE WHEN m < 0 OR m > 100 THEN NULL WHEN m >= 90 THEN 'A' WHEN m >= 80 THEN 'B' WHEN m >= 60 THEN 'C'
    WHEN m >= 40 THEN 'D' ELSE 'F' END AS grade FROM (SELECT o_orderkey, o_totalprice / 4500 - 5 AS m FROM orders)""")
def grade_bands(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", values.grade(F.col("o_totalprice") / 4500 - 5).alias("grade"))


@query("parity_rules", "F22", """SELECT c_custkey, CASE WHEN n > 0 AND n % 2 = 1 THEN n + 10 WHEN n > 0 THEN n * 10.5::DOUBLE WHEN n < 0 AND abs(n) % 2 = 1 THEN n - 10
    WHEN n < 0 THEN n / 10.3::DOUBLE ELSE n END::DOUBLE AS adjusted FROM (SELECT c_custkey, floor(c_acctbal / 10)::BIGINT AS n FROM customer)""")
def parity_rules(spark, sf):
    n = F.floor(F.col("c_acctbal") / 10).cast("long")
    return table(spark, sf, "customer").select("c_custkey", values.parity_adjust(n).alias("adjusted"))


@query("mean_of_columns", "F23", "SELECT l_orderkey, l_linenumber, (l_quantity + l_discount + l_tax) / 3 AS mean FROM lineitem")
def mean_of_columns(spark, sf):
    c = F.col
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", ((c("l_quantity") + c("l_discount") + c("l_tax")) / 3).alias("mean"))


@query("simple_interest", "F24", """SELECT o_orderkey, CASE WHEN kind = 'Saving' THEN a >= 10000 ELSE a >= 5000 END::INT AS eligible,
    CASE WHEN kind = 'Saving' AND a >= 10000 THEN a * 6.0::DOUBLE * m / 1200 END AS interest,
    CASE WHEN kind = 'Saving' THEN CASE WHEN a >= 10000 THEN 'ok' ELSE 'minimum is 10000' END
         ELSE CASE WHEN a >= 5000 THEN 'ok' ELSE 'minimum is 5000' END END AS reason
    FROM (SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'Saving' ELSE 'Current' END AS kind, o_totalprice / 10 AS a, month(o_orderdate) AS m FROM orders)""")
def simple_interest(spark, sf):
    kind = F.when(F.col("o_orderstatus") == "F", "Saving").otherwise("Current")
    rule = values.simple_interest(kind, F.col("o_totalprice") / 10, F.month("o_orderdate"))
    return table(spark, sf, "orders").withColumn("s", rule).select(
        "o_orderkey", F.col("s.eligible").cast("int").alias("eligible"), "s.interest", "s.reason"
    )


@query("factorials", "F25", "SELECT p_partkey, CASE WHEN p_size <= 20 THEN factorial(p_size)::BIGINT END AS f FROM part")
def factorials(spark, sf):
    return table(spark, sf, "part").select("p_partkey", F.factorial("p_size").alias("f"))


@query("array_functions", "F26", """SELECT vec_id, len(embedding)::INT AS size, embedding[1]::DOUBLE AS first,
    round(list_sum(embedding[2:4])::DOUBLE, 5) AS part_sum, round((list_sum(embedding[1:3]) + 3)::DOUBLE, 5) AS diagonal_sum FROM embeddings""")
def array_functions(spark, sf):
    e = F.col("embedding")
    add = lambda a, x: a + x
    head = F.slice(e, 1, 3)
    diagonal = F.zip_with(values.identity_matrix(3), head, lambda row, x: F.aggregate(row, F.lit(0.0), add) + x)
    return table(spark, sf, "embeddings").select(
        "vec_id", F.size(e).alias("size"), F.element_at(e, 1).cast("double").alias("first"),
        F.round(F.aggregate(F.slice(e, 2, 3), F.lit(0.0), add), 5).alias("part_sum"),
        F.round(F.aggregate(diagonal, F.lit(0.0), add), 5).alias("diagonal_sum"),
    )


@query("combine_lists", "F27 X3 U3", """SELECT l_orderkey, l_linenumber, list_max(a) + list_min(a) AS two, (list_sum(a) + l_linenumber)::BIGINT AS three,
    array_to_string(list_concat(list_transform(f, lambda x: x * x), list_filter(f, lambda x: x % 2 <> 0)), ',') AS four
    FROM (SELECT l_orderkey, l_linenumber, [l_orderkey, l_suppkey, l_quantity::BIGINT] AS a,
          [l_orderkey, l_suppkey, l_quantity::BIGINT, l_linenumber::BIGINT, l_partkey] AS f FROM lineitem)""")
def combine_lists(spark, sf):
    one, two = F.array("l_orderkey", "l_suppkey"), F.array(F.col("l_quantity").cast("long"))
    three, four = F.array(F.col("l_linenumber").cast("long")), F.array("l_partkey")
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", values.combine_lists([one, two])[0].alias("two"),
        values.combine_lists([one, two, three])[0].alias("three"),
        F.array_join(values.combine_lists([one, two, three, four]).cast("array<string>"), ",").alias("four"),
    )


@query("safe_arithmetic", "F28", """SELECT l_orderkey, l_linenumber, l_extendedprice / nullif(l_tax, 0) AS value,
    CASE WHEN l_tax = 0 THEN 'division by zero' END AS error, CASE WHEN l_returnflag = 'N' THEN l_partkey END AS number,
    CASE WHEN l_returnflag <> 'N' THEN 'not a whole number' END AS number_error FROM lineitem""")
def safe_arithmetic(spark, sf):
    word = F.when(F.col("l_returnflag") == "N", F.col("l_partkey").cast("string")).otherwise(
        F.concat(F.col("l_returnflag"), F.col("l_partkey").cast("string"))
    )
    li = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", values.safe_divide(F.col("l_extendedprice"), F.col("l_tax")).alias("d"),
        values.safe_int(word).alias("i"),
    )
    return li.select(
        "l_orderkey", "l_linenumber", "d.value", "d.error", F.col("i.value").cast("long").alias("number"), F.col("i.error").alias("number_error")
    )
