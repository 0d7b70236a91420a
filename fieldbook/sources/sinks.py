"""Writing results: reports as text and JSON, insight summaries, nested records."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RULE = "=" * 80


def _text_of(name: str, kind: str) -> Column:
    c = F.col(name)
    return F.coalesce(F.bround(c, 6).cast("string") if kind == "double" else c.cast("string"), F.lit("null"))


def key_value_lines(df: DataFrame, section: str, heading: str | None = None) -> DataFrame:
    """Lines 'name : value' for each column of each row, under a heading column if named."""
    fields = [(n, t) for n, t in df.dtypes if n != heading]
    items = [F.format_string("    %-30s: %s", F.lit(n), _text_of(n, t)) for n, t in fields]
    top = [F.concat(F.lit("  "), F.upper(F.col(heading)))] if heading else []
    order = F.col(heading) if heading else F.lit("")
    return df.select(F.lit(section).alias("section"), order.cast("string").alias("item"), F.posexplode(F.array(*top, *items)).alias("pos", "line"))


def table_lines(df: DataFrame, section: str, key: str) -> DataFrame:
    """One line per row of a small table, with a header line."""
    header = "".join(f"{n:>20}" for n in df.columns)
    body = df.select(
        F.lit(section).alias("section"), F.concat(F.lit("1"), F.col(key)).alias("item"), F.lit(0).alias("pos"),
        F.format_string("%20s" * len(df.columns), *[_text_of(n, t) for n, t in df.dtypes]).alias("line"),
    )
    head = df.sparkSession.createDataFrame([(section, "0", 0, header)], body.schema)
    return head.unionByName(body)


def insight_lines(insights: DataFrame, section: str) -> DataFrame:
    """Numbered insights, title line and body line."""
    title = F.format_string("  [%02d] [%s] %s", F.col("ord"), F.col("category"), F.col("title"))
    body = F.concat(F.lit("       "), F.col("body"))
    return insights.select(
        F.lit(section).alias("section"), F.format_string("%05d", F.col("ord")).alias("item"),
        F.posexplode(F.array(title, body)).alias("pos", "line"),
    )


def text_report(title: str, source: str, sections: Sequence[tuple[str, DataFrame]]) -> DataFrame:
    """(ord, line): all sections in the given order under a title block. Sections hold
    report rows: one per column, test or insight."""
    spark = sections[0][1].sparkSession
    frame = "section string, item string, pos int, line string"
    heads = [("", "0", i, line) for i, line in enumerate([RULE, f"  {title}", f"  Dataset   : {source}", RULE])]
    heads += [(name, "", -1, f"── {name.upper()} ──") for name, _ in sections]
    names = ["", *[name for name, _ in sections]]
    rank = F.create_map(*[x for i, n in enumerate(names) for x in (F.lit(n), F.lit(i))])
    lines = reduce(
        DataFrame.unionByName, [f.select("section", "item", "pos", "line") for _, f in sections],
        spark.createDataFrame(heads, frame),
    )
    return lines.select(rank[F.col("section")].alias("part"), "item", "pos", "line")


def write_text_report(report: DataFrame, path: str) -> None:
    """Write report lines in order as one text file; a report is a few hundred lines."""
    report.coalesce(1).sortWithinPartitions("part", "item", "pos").select("line").write.mode("overwrite").text(path)


def json_report(dataset: str, parts: Mapping[str, DataFrame]) -> DataFrame:
    """One row with column ``value``: the report as a JSON object. Parts hold report
    rows (per column, test, insight), so each fits one array."""
    spark = next(iter(parts.values())).sparkSession
    out = spark.range(1).select(F.struct(F.lit(dataset).alias("dataset")).alias("metadata"))
    for name, part in parts.items():
        rows = part.agg(F.sort_array(F.collect_list(F.to_json(F.struct("*")))).alias("r"))
        out = out.withColumn(name, rows.scalar())
    fields = [F.concat(F.lit('"metadata":'), F.to_json("metadata"))]
    fields += [
        F.concat(F.lit(f'"{name}":['), F.array_join(name, ","), F.lit("]")) for name in parts
    ]
    return out.select(F.concat(F.lit("{"), F.concat_ws(",", *fields), F.lit("}")).alias("value"))


def write_json_report(report: DataFrame, path: str) -> None:
    report.coalesce(1).write.mode("overwrite").text(path)


def insight_summary(insights: DataFrame) -> DataFrame:
    """(ord, category, items): insights by category in the order categories first appear."""
    return insights.groupBy("category").agg(
        F.min("ord").alias("ord"),
        F.array_sort(F.collect_list(F.struct("ord", "title", "body"))).alias("items"),
    ).select("ord", "category", "items")


def write_insight_summary(insights: DataFrame, path: str, title: str = "INSIGHT SUMMARY") -> None:
    """The summary as one text file."""
    rows = insight_summary(insights)
    line = lambda prefix, c: F.concat(F.lit(prefix), c)
    body = rows.select(
        "ord",
        F.concat(
            F.array(line("▶ ", F.upper("category"))),
            F.flatten(F.transform("items", lambda x: F.array(line("  • ", x["title"]), line("    ", x["body"]), F.lit("")))),
        ).alias("lines"),
    )
    head = rows.sparkSession.createDataFrame([(0, [title, "=" * 60, ""])], body.schema)
    (
        head.unionByName(body).select("ord", F.posexplode("lines").alias("pos", "value")).coalesce(1)
        .sortWithinPartitions("ord", "pos").select("value").write.mode("overwrite").text(path)
    )


def write_partitioned(df: DataFrame, path: str, by: Sequence[str] = ()) -> None:
    """A materialised extract as parquet, laid out by the columns later filtered on."""
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*by) if by else writer).parquet(path)
