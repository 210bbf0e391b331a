"""Queries over the operators for training data, and their SQL."""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import is_missing, plain, plain_slice, sql_missing, sql_plain, sql_plain_slice
from ..operators.slices import chrom_name
from ..plans.tables import table
from ..session import settled
from . import packing, patterns, tokenize
from .cooccurrence import cooccurrence
from .fusion import first_in_trust, fuse
from .stuffing import stuffed_share


def _contacts(spark: SparkSession, sf_dir: str, min_count: int) -> DataFrame:
    slices = table(spark, sf_dir, "slices").where(~is_missing(F.col("parent_read")))
    reads = slices.select("bam", plain(F.col("parent_read")).alias("read"), "restriction_fragment")
    return cooccurrence(reads, "bam", "read", "restriction_fragment", min_count=min_count)


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fragment pairs of a bam in 8 reads or more, and ten times as many as by chance."""
    found = _contacts(spark, sf_dir, 8).where("n_ab * n >= 10 * n_a * n_b")
    return found.select(F.col("grp").alias("bam"), F.col("item_a").alias("fragment_a"), F.col("item_b").alias("fragment_b"))


def p1_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every pair of fragments of a bam, with counts, lift and the log odds ratio."""
    pairs = _contacts(spark, sf_dir, 1)
    return pairs.select(
        F.col("grp").alias("bam"), F.col("item_a").alias("fragment_a"), F.col("item_b").alias("fragment_b"),
        "n_ab", "n_a", "n_b", "n", F.round("lift", 6).alias("lift"), F.round("log_odds", 6).alias("log_odds"),
    )


def _alignment_rank() -> Column:
    """2 for uniquely aligned, 1 for multimapped, 0 where that isn't known."""
    return F.when(F.col("multimapped") == 0, 2).when(F.col("multimapped") == 1, 1).otherwise(0)


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of each slice delivered twice or more, the records to take chrom and multimapped from."""
    trust = {
        "chrom_record_id": [~is_missing(F.col("chrom")), _alignment_rank(), F.col("loaded_at")],
        "multimapped_record_id": [F.col("multimapped").isNotNull(), F.col("loaded_at")],
    }
    first = first_in_trust(table(spark, sf_dir, "slices"), plain_slice(F.col("slice_name")), trust, "record_id", min_records=2)
    return first.withColumnRenamed("key", "slice_name")


def p2_fused(spark: SparkSession, sf_dir: str) -> DataFrame:
    """chrom and multimapped of every slice by Bayesian fusion of what the loading days delivered."""
    slices = table(spark, sf_dir, "slices")
    fields = {"chrom": chrom_name(F.col("chrom")), "multimapped": F.col("multimapped").cast("string")}
    best = fuse(slices, plain_slice(F.col("slice_name")), fields, F.col("loaded_at").cast("date"))
    of = lambda f, c: F.max(F.when(F.col("field") == f, F.col(c)))
    return best.groupBy(F.col("key").alias("slice_name")).agg(
        of("chrom", "value").alias("chrom"), of("chrom", "posterior").alias("chrom_posterior"),
        of("multimapped", "value").cast("int").alias("multimapped"), of("multimapped", "posterior").alias("multimapped_posterior"),
    )


def _deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two rows for each record: its slice in (bam, day, ''), its read in (bam, day, capture)."""
    slices = table(spark, sf_dir, "slices")
    day = F.date_format("loaded_at", "yyyy-MM-dd").alias("load_day")
    by_slice = slices.select("bam", day, F.lit("").alias("capture"), F.concat(F.lit("s|"), plain_slice(F.col("slice_name"))).alias("identifier"))
    named = slices.where(~is_missing(F.col("parent_read")) & ~is_missing(F.col("capture")))
    by_read = named.select("bam", day, plain(F.col("capture")).alias("capture"), F.concat(F.lit("r|"), plain(F.col("parent_read"))).alias("identifier"))
    return by_slice.unionByName(by_read)


CELL = ["bam", "load_day", "capture"]


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells with 20 records or more, of which at most half are different."""
    rows = _deliveries(spark, sf_dir)
    cells, seed = patterns.cells_of(rows, CELL)
    totals = patterns.pattern_totals(patterns.memberships(rows, "identifier", patterns.cell_code(CELL, seed)))
    counted = cells.where("n_records >= 20").join(patterns.distinct_per_cell(totals), "cell")
    return counted.where("2 * n_distinct <= n_records").select(*CELL)


SUBSETS = tuple(list(dims) for k in (1, 2, 3) for dims in combinations(CELL, k))


def _identifiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two rows for each record: its slice and its read, both in (bam, day, capture); capture '' where it is missing.

    A missing parent_read names no read: its identifier is NULL.
    """
    slices = table(spark, sf_dir, "slices")
    capture = F.when(is_missing(F.col("capture")), "").otherwise(plain(F.col("capture"))).alias("capture")
    read = F.when(~is_missing(F.col("parent_read")), plain(F.col("parent_read")))
    cell = ["bam", F.date_format("loaded_at", "yyyy-MM-dd").alias("load_day"), capture]
    named = lambda kind, name: slices.select(F.lit(kind).alias("kind"), *cell, F.concat(F.lit(f"{kind}|"), name).alias("identifier"))
    return named("slice", plain_slice(F.col("slice_name"))).unionByName(named("read", read))


def p5_combinations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Different slices and reads for bams, days, captures and all their combinations, over all records.

    NULL stands for a dimension that isn't of the combination, capture '' for records without a capture.
    """
    rows = _identifiers(spark, sf_dir)
    cells, seed = patterns.cells_of(rows, ["kind", *CELL])
    totals = patterns.pattern_totals(patterns.memberships(rows, "identifier", patterns.cell_code(["kind", *CELL], seed)))
    return patterns.distinct_per_each(totals, cells, [["kind", *dims] for dims in SUBSETS]).select("kind", *CELL, "n_distinct")


def _days(spark: SparkSession, sf_dir: str, every: int, rest: int) -> tuple[DataFrame, DataFrame]:
    """Memberships of slices in loading days, of records with a number of such a rest; and the days' codes."""
    slices = table(spark, sf_dir, "slices").where(F.pmod("record_id", F.lit(every)) == rest)
    rows = slices.select(F.date_format("loaded_at", "yyyy-MM-dd").alias("load_day"), plain_slice(F.col("slice_name")).alias("identifier"))
    return patterns.memberships(rows, "identifier", patterns.cell_code(["load_day"], 0)), rows.select("load_day").distinct()


def p5_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Different slices in each loading day and the day after, from memberships of three parts of all records, merged."""
    parts = [_days(spark, sf_dir, 3, rest) for rest in range(3)]
    totals = settled(patterns.pattern_totals(patterns.merge_memberships([m for m, _ in parts])), "pattern-totals")
    days = reduce(DataFrame.unionByName, [d for _, d in parts]).where("load_day IS NOT NULL").distinct()
    after = F.date_format(F.date_add(F.to_date("load_day"), 1), "yyyy-MM-dd")
    codes = days.select("load_day", F.explode(F.array("load_day", after)).alias("day"))
    codes = codes.select("load_day", patterns.cell_code(["load_day"], 0).alias("own"), F.col("day").alias("load_day_2"))
    cells = codes.select(F.col("load_day").alias("first"), F.col("load_day_2").alias("load_day")).withColumn("cell", patterns.cell_code(["load_day"], 0))
    return patterns.distinct_per(totals, cells.select("cell", F.col("first").alias("load_day")), ["load_day"])


def p5_combination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slices delivered by the first two bams both, by either, and by the first alone, of all bams."""
    rows = table(spark, sf_dir, "slices").select("bam", plain_slice(F.col("slice_name")).alias("identifier"))
    totals = settled(patterns.pattern_totals(patterns.memberships(rows, "identifier", patterns.cell_code(["bam"], 0))), "pattern-totals")
    first = [r.bam for r in rows.select("bam").distinct().orderBy("bam").limit(2).collect()] or [""]
    code = lambda *names: F.array(*[F.xxhash64(F.lit(0), F.lit(False), F.lit(n)) for n in names])
    one, other = code(first[0]), code(first[-1])
    asked = {"both": ([one, other], None), "first_only": ([one], other), "either": ([code(*first)], None)}
    out = [patterns.combination(totals, all_of=all_of, none_of=none_of).withColumn("asked", F.lit(k)) for k, (all_of, none_of) in asked.items()]
    return reduce(DataFrame.unionByName, out)


def p6_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The token ids of every document."""
    return tokenize.encode(table(spark, sf_dir, "documents"), "doc_id", "text")


def _containers(spark: SparkSession, sf_dir: str, most: int = 1000) -> list[tuple[str, int]]:
    sizes = table(spark, sf_dir, "container_sizes").where("capacity_tokens >= 1").distinct().limit(most + 1).collect()
    if len(sizes) > most:
        raise ValueError(f"more than {most} kinds of containers")
    return sorted((r.container_kind, r.capacity_tokens) for r in sizes)


def _packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    sizes = tokenize.count_tokens(documents, "doc_id", "text")
    return packing.pack(sizes, "doc_id", "n_tokens", _containers(spark, sf_dir), n_items=documents.count())


def p7_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The container of each document, or piece of a document larger than the capacity, for each kind."""
    return _packed(spark, sf_dir)


def p7_unused(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Containers of each kind, the tokens in them, and the share of room left unused."""
    per = _packed(spark, sf_dir).groupBy("container_kind", "container_id").agg(F.sum("n_tokens").alias("tokens"))
    used = per.groupBy("container_kind").agg(F.count(F.lit(1)).alias("n_containers"), F.sum("tokens").alias("tokens"))
    sizes = table(spark, sf_dir, "container_sizes").distinct()
    room = F.col("n_containers") * F.col("capacity_tokens")
    return used.join(sizes, "container_kind").select("container_kind", "n_containers", "tokens", F.round(1 - F.col("tokens") / room, 4).alias("unused"))


def p8_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The share of each document's characters that is stuffing."""
    return stuffed_share(table(spark, sf_dir, "documents"), "doc_id", "text", "lang").select("doc_id", F.round("share", 4).alias("share"))


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that are stuffing for more than half of their characters."""
    return stuffed_share(table(spark, sf_dir, "documents"), "doc_id", "text", "lang").where("share > 0.5").select("doc_id")


def queries() -> dict:
    return {f.__name__: f for f in (p1_found, p1_pairs, p2_found, p2_fused, p5_found, p5_combinations, p5_merged, p5_combination, p6_ids, p7_containers, p7_unused, p8_shares, p8_found)}


def oracle_sql() -> dict[str, str]:
    read, missing_read = sql_plain("parent_read"), sql_missing("parent_read")
    pairs = f"""
        r AS MATERIALIZED (SELECT DISTINCT bam, {read} AS read, restriction_fragment AS f FROM slices WHERE NOT {missing_read}),
        n AS (SELECT bam, count(DISTINCT read) AS n FROM r GROUP BY bam),
        one AS MATERIALIZED (SELECT bam, f, count(*) AS n_f FROM r WHERE f IS NOT NULL GROUP BY ALL),
        two AS MATERIALIZED (SELECT x.bam, x.f AS a, y.f AS b, count(*) AS n_ab FROM r x JOIN r y ON x.bam = y.bam AND x.read = y.read AND x.f < y.f GROUP BY ALL),
        left_of AS MATERIALIZED (SELECT two.*, p.n_f AS n_a FROM two JOIN one p ON p.bam = two.bam AND p.f = a),
        both_of AS MATERIALIZED (SELECT l.*, q.n_f AS n_b FROM left_of l JOIN one q ON q.bam = l.bam AND q.f = b),
        pairs AS (SELECT x.bam, a AS fragment_a, b AS fragment_b, n_ab, n_a, n_b, n FROM both_of x JOIN n ON n.bam = x.bam)"""
    day = "strftime(loaded_at, '%Y-%m-%d')"
    deliveries = f"""
        d AS (
            SELECT 'slice' AS kind, bam, {day} AS load_day, CASE WHEN {sql_missing("capture")} THEN '' ELSE {sql_plain("capture")} END AS capture,
                {sql_plain_slice("slice_name")} AS identifier FROM slices
            UNION ALL SELECT 'read', bam, {day}, CASE WHEN {sql_missing("capture")} THEN '' ELSE {sql_plain("capture")} END, {read} FROM slices WHERE NOT {missing_read})"""
    combined = " UNION ALL ".join(
        f"SELECT kind, {', '.join(d if d in dims else f'CAST(NULL AS VARCHAR) AS {d}' for d in CELL)}, count(DISTINCT identifier) AS n_distinct FROM d GROUP BY kind, {', '.join(dims)}"
        for dims in SUBSETS
    )
    return {
        "p5_combinations": f"WITH {deliveries} {combined}",
        "p5_merged": f"""
            WITH r AS (SELECT DISTINCT CAST(loaded_at AS DATE) AS day, {sql_plain_slice("slice_name")} AS identifier FROM slices WHERE loaded_at IS NOT NULL),
            w AS (SELECT day AS first, identifier FROM r UNION ALL SELECT d.day, identifier FROM (SELECT DISTINCT day FROM r) d JOIN r ON r.day = d.day + 1)
            SELECT strftime(first, '%Y-%m-%d') AS load_day, count(DISTINCT identifier) AS n_distinct FROM w GROUP BY first""",
        "p5_combination": f"""
            WITH b AS (SELECT min(bam) AS one, (SELECT max(bam) FROM (SELECT DISTINCT bam FROM slices ORDER BY bam LIMIT 2)) AS other FROM slices),
            i AS (SELECT {sql_plain_slice("slice_name")} AS identifier, bool_or(bam = one) AS x, bool_or(bam = other) AS y FROM slices, b GROUP BY 1)
            SELECT unnest(['both', 'first_only', 'either']) AS asked, unnest([count(*) FILTER (x AND y), count(*) FILTER (x AND NOT y), count(*) FILTER (x OR y)]) AS n_distinct FROM i""",
        "p1_found": f"WITH {pairs} SELECT bam, fragment_a, fragment_b FROM pairs WHERE n_ab >= 8 AND n_ab * n >= 10 * n_a * n_b",
        "p1_pairs": f"""WITH {pairs} SELECT *, round(n_ab * n / (n_a::DOUBLE * n_b), 6) AS lift,
            round(ln((n_ab + 0.5) * (n - n_a - n_b + n_ab + 0.5) / ((n_a - n_ab + 0.5) * (n_b - n_ab + 0.5))), 6) AS log_odds FROM pairs""",
        "p2_found": f"""
            WITH s AS (
                SELECT {sql_plain_slice("slice_name")} AS slice_name, record_id, loaded_at, multimapped,
                    CAST({sql_missing("chrom")} AS INTEGER) AS lost, CASE multimapped WHEN 0 THEN 0 WHEN 1 THEN 1 ELSE 2 END AS alignment
                FROM slices)
            SELECT slice_name, arg_min(record_id, (lost, alignment, -epoch_us(loaded_at), record_id)) AS chrom_record_id,
                arg_min(record_id, (CAST(multimapped IS NULL AS INTEGER), -epoch_us(loaded_at), record_id)) AS multimapped_record_id
            FROM s GROUP BY slice_name HAVING count(*) >= 2""",
        "p5_found": f"""
            SELECT bam, {day} AS load_day, '' AS capture FROM slices GROUP BY 1, 2
            HAVING count(*) >= 20 AND 2 * count(DISTINCT {sql_plain_slice("slice_name")}) <= count(*)
            UNION ALL
            SELECT bam, {day} AS load_day, {sql_plain("capture")} AS capture FROM slices
            WHERE NOT {missing_read} AND NOT {sql_missing("capture")} GROUP BY 1, 2, 3
            HAVING count(*) >= 20 AND 2 * count(DISTINCT {read}) <= count(*)""",
    }
