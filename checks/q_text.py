"""Text and date expressions over whole texts."""

from pyspark.sql import functions as F

from checks.registry import query
from checks.views import ascii_sql, date_sql, norm_sql, safe_sql, strip_sql, table
from gridloom import functions as G


@query(
    "normalize_text",
    f"""SELECT doc_id, md5({norm_sql('text')}) AS norm, md5(lower({strip_sql('text')})) AS light,
               md5({strip_sql('text')}) AS stripped
        FROM documents""",
)
def normalize_text(spark, sf):
    text = F.col("text")
    return table(spark, sf, "documents").select(
        "doc_id",
        F.md5(G.normalize(text)).alias("norm"),
        F.md5(G.light_normalize(text)).alias("light"),
        F.md5(G.strip(text)).alias("stripped"),
    )


@query(
    "ascii_clean",
    f"SELECT doc_id, md5({ascii_sql('text')}) AS cleaned FROM documents",
)
def ascii_clean(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id", F.md5(G.clean_ascii(F.col("text"))).alias("cleaned")
    )


@query(
    "safe_name",
    f"SELECT doc_id, md5({safe_sql('text')}) AS name FROM documents",
)
def safe_name(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id", F.md5(G.safe_name(F.col("text"))).alias("name")
    )


_RAW_SQL = """
    raw AS (
      SELECT o_orderkey,
             CASE o_orderkey % 6 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d')
                                 WHEN 1 THEN strftime(o_orderdate, '%d/%m/%Y')
                                 WHEN 2 THEN strftime(o_orderdate, '%Y/%-m/%-d')
                                 WHEN 3 THEN ' ' || strftime(o_orderdate, '%-d/%-m/%Y')
                                 WHEN 4 THEN strftime(o_orderdate, '%Y') || '-02-30'
                                 ELSE 'Été ' || strftime(o_orderdate, '%y-%m-%d') END AS t
      FROM orders)"""


@query(
    "parse_dates",
    f"""WITH {_RAW_SQL}
        SELECT o_orderkey, t AS raw, {date_sql('t')} AS day, {date_sql('t', True)} AS form_day
        FROM raw""",
)
def parse_dates(spark, sf):
    day, key = F.col("o_orderdate"), F.col("o_orderkey")
    raw = (
        F.when(key % 6 == 0, F.date_format(day, "yyyy-MM-dd"))
        .when(key % 6 == 1, F.date_format(day, "dd/MM/yyyy"))
        .when(key % 6 == 2, F.date_format(day, "yyyy/M/d"))
        .when(key % 6 == 3, F.concat(F.lit(" "), F.date_format(day, "d/M/yyyy")))
        .when(key % 6 == 4, F.concat(F.date_format(day, "yyyy"), F.lit("-02-30")))
        .otherwise(F.concat(F.lit("Été "), F.date_format(day, "yy-MM-dd")))
    )
    return table(spark, sf, "orders").select(
        "o_orderkey",
        raw.alias("raw"),
        G.format_date(raw).alias("day"),
        G.format_date(raw, form_variant=True).alias("form_day"),
    )


@query(
    "relative_minutes",
    """WITH t AS (
         SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity,
                CASE l_orderkey % 4 WHEN 0 THEN 'T0+' || (l_partkey % 90) || 'min'
                                    WHEN 1 THEN 'T+' || (l_suppkey % 5) || 'h' || (l_partkey % 60)
                                    WHEN 2 THEN ' t0 - ' || (l_partkey % 30)
                                    ELSE '10:' || (l_partkey % 60) END AS raw
         FROM lineitem)
       SELECT raw, CASE l_orderkey % 4 WHEN 0 THEN l_partkey % 90
                                       WHEN 1 THEN (l_suppkey % 5) * 60 + l_partkey % 60
                                       WHEN 2 THEN -(l_partkey % 30) END AS minutes,
              count(*) AS n
       FROM t GROUP BY ALL""",
)
def relative_minutes(spark, sf):
    order, part = F.col("l_orderkey"), F.col("l_partkey")
    raw = (
        F.when(order % 4 == 0, F.concat(F.lit("T0+"), part % 90, F.lit("min")))
        .when(order % 4 == 1, F.concat(F.lit("T+"), F.col("l_suppkey") % 5, F.lit("h"), part % 60))
        .when(order % 4 == 2, F.concat(F.lit(" t0 - "), part % 30))
        .otherwise(F.concat(F.lit("10:"), part % 60))
    )
    texts = table(spark, sf, "lineitem").groupBy(raw.alias("raw")).agg(F.count("*").alias("n"))
    return texts.select("raw", G.relative_minutes(F.col("raw")).alias("minutes"), "n")
