"""Mixing sources to target weights by Poisson replication.

Each source has a target share of the characters. Its rate is the number of times that its
documents should occur on average. How often one document occurs is the Poisson quantile,
at that rate, of a uniform number made from its id and a seed, so the same input gives the
same mixture on any cluster. A rate above ``PART_RATE`` is cut into equal parts that are drawn
on their own, each with a seed of its own; their sum has the same distribution, and however
large a rate is, a row is repeated by bounded steps. Documents are repeated that many times,
or left out at 0, and all are dealt out and ordered by a hash of seed, row and copy.

Only DataFrame functions are used. Per source one row is kept, with the cumulative
probabilities of a part of its rate, some 1,400 numbers at most; a source of any size needs no
group of its rows.

Edge cases: a document counts as its characters and one more, so sources of null or empty
texts have a size; rows without a source are a source of their own; a row without an id is
drawn by its text; repeated rows are drawn alike; a source that has no weight gets no share; a
source may be repeated any number of times; copies are numbered from 1, from part to part by
``PART_STEP`` further; a table without rows gives none; columns of the input are kept, whatever
their names, and ``copy_no`` is added unless it is to be left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from treewatt.functions.tables import sized
from treewatt.llm.common import Scratch

SEED = 17
ALPHA = 0.5
BROADCAST_ROWS = 2_000  # of at most 12 kB
PART_RATE = 1_000.0
PART_STEP = 2_048  # above the greatest count of a part
PARTS_AT_ONCE = 4_096


def row_name(id_col: Column, text_col: Column) -> Column:
    """What a row is drawn by: its id, or the md5 of its text where it has none."""
    by_text = F.concat(F.lit("text:"), F.md5(F.coalesce(text_col.cast("string"), F.lit(""))))
    return F.coalesce(id_col.cast("string"), by_text)


def uniform(name: Column, seed: int, part: Column) -> Column:
    """A number in [0, 1) of 52 bits from the md5 of seed, name and, from the second, part."""
    which = F.when(part > 0, F.concat(F.lit(":"), part.cast("string"))).otherwise(F.lit(""))
    text = F.concat(F.lit(f"{seed}:"), name, which)
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") / F.lit(2.0**52)


def poisson_table(rate: Column) -> Column:
    """P(X <= n) for n from 0 to where it is 1 but for rounding; rates up to PART_RATE."""
    last = F.ceil(rate + 12 * F.sqrt(rate) + 30).cast("int")
    zero = F.struct(
        (-rate).alias("log"), F.exp(-rate).alias("sum"), F.array(F.exp(-rate)).alias("table")
    )

    def longer(state: Column, k: Column) -> Column:
        log = state["log"] + F.ln(rate) - F.ln(k)
        total = state["sum"] + F.exp(log)
        return F.struct(
            log.alias("log"), total.alias("sum"), F.concat(state["table"], F.array(total)).alias("table")
        )

    made = F.aggregate(F.sequence(F.lit(1), last), zero, longer, lambda s: s["table"])
    return F.when(rate > 0, made).otherwise(F.array(F.lit(1.0)))


def source_rates(
    docs: DataFrame,
    weights: dict[str, float] | None,
    alpha: float,
    epochs: float,
    source_col: str,
    text_col: str,
    scratch: Scratch,
) -> DataFrame:
    """(source, rate, parts, table) of each source; without weights shares go as size to the alpha."""
    size = F.coalesce(F.length(text_col), F.lit(0)).cast("bigint") + 1
    sizes = scratch.write(
        docs.groupBy(F.col(source_col).cast("string").alias("source")).agg(F.sum(size).alias("size")),
        "sizes",
    )
    if weights is None:
        weight = F.pow(F.col("size").cast("double"), F.lit(alpha))
    else:
        named = F.lit(0.0)
        for name, value in weights.items():
            named = F.when(F.col("source") == name, F.lit(float(value))).otherwise(named)
        weight = named
    weighed = sizes.withColumn("weight", weight)
    chars, total = weighed.agg(F.sum("size"), F.sum("weight")).first()
    scale = epochs * chars / total if total else 0.0
    rate = F.lit(scale) * F.col("weight") / F.col("size")
    parts = F.greatest(F.ceil(F.col("rate") / PART_RATE), F.lit(1)).cast("bigint")
    return (
        weighed.withColumn("rate", rate)
        .withColumn("parts", parts)
        .select("source", "rate", "parts", poisson_table(F.col("rate") / F.col("parts")).alias("table"))
    )


def _in_parts(rows: DataFrame) -> DataFrame:
    """A row for each part; those of many parts are repeated in two steps."""
    last = (F.col("_parts") - 1).cast("bigint")
    blocks = F.sequence(F.lit(0).cast("bigint"), F.floor(last / PARTS_AT_ONCE))
    first = F.col("_block") * PARTS_AT_ONCE
    inside = F.sequence(first, F.least(first + PARTS_AT_ONCE - 1, last))
    return rows.withColumn("_block", F.explode(blocks)).withColumn("_part", F.explode(inside))


def mix_sources(
    docs: DataFrame,
    weights: dict[str, float] | None = None,
    alpha: float = ALPHA,
    epochs: float = 1.0,
    seed: int = SEED,
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
    number_copies: bool = True,
) -> DataFrame:
    """docs, each row as often as its draw says, in an order by hash; copy_no counts from 1.

    epochs is the size of the mixture in characters, in units of the input's.
    """
    scratch = Scratch(docs.sparkSession, "mixing")
    rates = scratch.write(
        source_rates(docs, weights, alpha, epochs, source_col, text_col, scratch), "rates"
    )
    count, most = rates.agg(F.count(F.lit(1)), F.max("parts")).first()
    rates = rates.select(F.col("source").alias("_source"), F.col("parts").alias("_parts"), "table")
    rows = docs.select(F.struct("*").alias("_row"))
    source = F.col(f"_row.{source_col}").cast("string")
    joined = rows.join(sized(rates, count, BROADCAST_ROWS), source.eqNullSafe(F.col("_source")))
    if (most or 1) > 1:
        joined = _in_parts(joined)
    else:
        joined = joined.withColumn("_part", F.lit(0).cast("bigint"))
    name = row_name(F.col(f"_row.{id_col}"), F.col(f"_row.{text_col}"))
    drawn = joined.withColumn("_u", uniform(name, seed, F.col("_part")))
    count = F.aggregate(
        "table", F.lit(0), lambda n, p: n + F.when(p <= F.col("_u"), 1).otherwise(0)
    )
    copies = drawn.select("_row", "_part", count.alias("_count")).where("_count > 0")
    numbered = copies.select(
        "_row", "_part", F.explode(F.sequence(F.lit(1), F.col("_count"))).alias("_copy")
    ).select("_row", (F.col("_part") * PART_STEP + F.col("_copy")).alias("copy_no"))
    key = F.xxhash64(F.lit(seed), f"_row.{id_col}", f"_row.{text_col}", "copy_no")
    dealt = numbered.withColumn("_key", key).repartition("_key").sortWithinPartitions("_key")
    if number_copies:
        kept = [c for c in docs.columns if c != "copy_no"]
        return dealt.select(*[f"_row.`{c}`" for c in kept], "copy_no")
    return dealt.select("_row.*")


def op5_mix_sources(spark, sf_dir: str) -> DataFrame:
    return mix_sources(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def mixture_sql(docs: str, columns: str) -> str:
    """The same draw in SQL over a table or query docs."""
    return f"""
WITH docs AS ({docs}),
sizes AS (SELECT source, sum(length(coalesce(text, '')) + 1) AS size FROM docs GROUP BY source),
total AS (SELECT sum(size) AS chars, sum(pow(CAST(size AS DOUBLE), {ALPHA})) AS weight FROM sizes),
rates AS (SELECT source, chars / weight * pow(CAST(size AS DOUBLE), {ALPHA}) / size AS rate
          FROM sizes, total),
parts AS (SELECT source, rate / n AS rate, n
          FROM (SELECT source, rate, greatest(CAST(ceil(rate / 1000.0) AS BIGINT), 1) AS n FROM rates)),
terms AS (SELECT source, k, exp(-rate + k * ln(rate) - lgamma(k + 1)) AS p
          FROM (SELECT source, rate, unnest(range(0, CAST(ceil(rate + 12 * sqrt(rate) + 30) AS BIGINT) + 1)) AS k
                FROM parts)),
steps AS (SELECT source, k, sum(p) OVER (PARTITION BY source ORDER BY k) AS below FROM terms),
named AS (SELECT d.*, unnest(range(0, n)) AS part,
                 coalesce(CAST(doc_id AS VARCHAR), 'text:' || md5(coalesce(text, ''))) AS name
          FROM docs d JOIN parts p ON p.source IS NOT DISTINCT FROM d.source),
drawn AS (SELECT *, CAST('0x' || substr(md5(
                      '{SEED}:' || name || CASE WHEN part > 0 THEN ':' || part ELSE '' END), 1, 13)
                    AS BIGINT) / 4503599627370496.0 AS u FROM named),
counted AS (SELECT d.*, (SELECT count(*) FROM steps s
              WHERE s.source IS NOT DISTINCT FROM d.source AND s.below <= d.u) AS copies FROM drawn d)
SELECT {columns} FROM (SELECT *, part * 2048 + unnest(range(1, copies + 1)) AS copy FROM counted)
"""


ORACLE_SQL = {
    "op5_mix_sources": mixture_sql(
        "SELECT * FROM documents",
        "doc_id, text, lang, source, n_chars, CAST(copy AS BIGINT) AS copy_no",
    )
}
