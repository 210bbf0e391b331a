"""Slice filters one by one, the assays' programs, and their statistics by stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import filters
from ..operators.slices import clean_slices, sql_clean
from .registry import Registry
from .tables import table

R = Registry()
queries, oracle_sql = R.queries, R.oracle_sql

#: Each filter in SQL, over a table of slices t.
FILTER_SQL = {
    "get_unfiltered_slices": "SELECT * FROM {t}",
    "remove_unmapped_slices": "SELECT * FROM {t} WHERE mapped = 1",
    "remove_orphan_slices": "SELECT * FROM {t} WHERE parent_id IN (SELECT parent_id FROM {t} GROUP BY 1 HAVING count(*) > 1)",
    "remove_multi_capture_fragments": "SELECT * FROM {t} WHERE parent_id IN (SELECT parent_id FROM {t} GROUP BY 1 HAVING count(DISTINCT capture) = 1)",
    "remove_excluded_slices": """SELECT * FROM {t} WHERE parent_id IN (
        SELECT a.parent_id FROM {t} a LEFT JOIN (SELECT parent_id, capture AS viewpoint FROM {t} WHERE capture_count = 1) c ON c.parent_id = a.parent_id
        WHERE a.exclusion_count < 1 OR a.exclusion IS DISTINCT FROM c.viewpoint)""",
    "remove_blacklisted_slices": "SELECT * FROM {t} WHERE coalesce(blacklist, 0) = 0",
    "remove_non_reporter_fragments": """SELECT * FROM {t} WHERE parent_id IN (
        SELECT parent_id FROM {t} GROUP BY 1 HAVING sum(mapped) - sum(capture_count) - sum(blacklist) - sum(exclusion_count) > 0)""",
    "remove_viewpoint_adjacent_restriction_fragments": """SELECT * FROM {t} WHERE parent_id NOT IN (
        SELECT a.parent_id FROM {t} a JOIN (SELECT parent_id, capture FROM {t} WHERE capture_count = 1) c ON c.parent_id = a.parent_id
        JOIN (SELECT DISTINCT capture, restriction_fragment AS rf FROM {t} WHERE capture_count = 1) r ON r.capture = c.capture
        WHERE a.capture_count = 0 AND a.restriction_fragment BETWEEN r.rf - 1 AND r.rf + 1)""",
    "remove_duplicate_slices": """SELECT * FROM {t} WHERE parent_id IN (
        SELECT min(parent_id) FROM (SELECT parent_id, string_agg(coordinates, '|' ORDER BY slice, slice_id) AS signature FROM {t} GROUP BY 1) GROUP BY signature)""",
    "remove_duplicate_slices_pe": """SELECT * FROM {t} WHERE NOT EXISTS (SELECT 1 FROM {t} WHERE pe = 'pe') OR parent_id IN (
        SELECT min(parent_id) FROM (
            SELECT parent_id, arg_min(chrom, (slice, slice_id)) AS c, arg_min(start_pos, (slice, slice_id)) AS f, arg_max(end_pos, (slice, slice_id)) AS l FROM {t} GROUP BY 1)
        GROUP BY c, f, l)""",
    "remove_duplicate_re_frags": "SELECT * FROM {t} QUALIFY row_number() OVER (PARTITION BY parent_id, restriction_fragment ORDER BY slice, slice_id) = 1",
    "remove_slices_without_re_frag_assigned": "SELECT * FROM {t} WHERE restriction_fragment IS NOT NULL",
    "remove_slices_with_one_reporter": """SELECT * FROM {t} WHERE parent_id IN (
        SELECT parent_id FROM {t} GROUP BY 1 HAVING sum(capture_count) > 0 AND sum(mapped) - sum(exclusion_count) - sum(capture_count) - sum(blacklist) > 1)""",
    "remove_slices_outside_capture": "SELECT * FROM {t} WHERE capture_count <> 0",
    "remove_non_capture_fragments": "SELECT * FROM {t} WHERE parent_id IN (SELECT parent_id FROM {t} GROUP BY 1 HAVING sum(capture_count) > 0)",
    "remove_dual_capture_fragments": """SELECT * FROM {t} WHERE parent_id NOT IN (
        SELECT parent_id FROM {t} WHERE capture_count = 1 GROUP BY 1 HAVING count(DISTINCT capture) > 1)""",
    "remove_religation": """SELECT * FROM {t} QUALIFY coalesce(
        restriction_fragment - lag(restriction_fragment) OVER (PARTITION BY parent_id ORDER BY restriction_fragment ASC NULLS LAST, slice_id), 2) > 1""",
}


def slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_slices(table(spark, sf_dir, "slices"))


def sql_program(program: str, last: str = "kept") -> str:
    """Common table expressions from s to the program's result, named by ``last``."""
    steps, t = [], "s"
    names = [f for fs in filters.PROGRAMS[program].values() for f in fs]
    for i, name in enumerate(names):
        out = last if i == len(names) - 1 else f"{last}{i}"
        steps.append(f"{out} AS MATERIALIZED ({FILTER_SQL[name].format(t=t)})")
        t = out
    return ",\n".join(steps)


def _one(name: str, query: str, mapped: bool = False) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = slices(spark, sf_dir)
        df = filters.remove_unmapped_slices(df) if mapped else df
        return filters.REGISTRY[name](df).select("slice_id", "parent_id", "capture", "restriction_fragment")

    start = "SELECT * FROM s WHERE mapped = 1" if mapped else "SELECT * FROM s"
    R.add(query, run, f"WITH {sql_clean()}, t AS ({start}) SELECT slice_id, parent_id, capture, restriction_fragment FROM ({FILTER_SQL[name].format(t='t')})")


for _name, _query, _mapped in (
    ("get_unfiltered_slices", "filter_unfiltered", False),
    ("remove_unmapped_slices", "filter_unmapped", False),
    ("remove_orphan_slices", "filter_orphan", False),
    ("remove_multi_capture_fragments", "filter_multi_capture", False),
    ("remove_excluded_slices", "filter_excluded", True),
    ("remove_blacklisted_slices", "filter_blacklisted", False),
    ("remove_non_reporter_fragments", "filter_non_reporter", True),
    ("remove_viewpoint_adjacent_restriction_fragments", "filter_adjacent_rf", True),
    ("remove_duplicate_slices", "filter_dup_slices", True),
    ("remove_duplicate_slices_pe", "filter_dup_slices_pe", True),
    ("remove_duplicate_re_frags", "filter_dup_rf", False),
    ("remove_slices_without_re_frag_assigned", "filter_missing_rf", False),
    ("remove_slices_with_one_reporter", "filter_one_reporter", True),
    ("remove_slices_outside_capture", "filter_outside_capture", False),
    ("remove_non_capture_fragments", "filter_non_capture", False),
    ("remove_dual_capture_fragments", "filter_dual_capture", False),
    ("remove_religation", "filter_religation", False),
):
    _one(_name, _query, _mapped)


def _program(name: str) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return filters.run_program(slices(spark, sf_dir), name).select("slice_id", "parent_id", "capture", "restriction_fragment")

    R.add(f"program_{name}", run, f"WITH {sql_clean()}, {sql_program(name)} SELECT slice_id, parent_id, capture, restriction_fragment FROM kept")


def _stage_stats(name: str) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return filters.stage_stats(slices(spark, sf_dir), name)

    parts, steps, t, i = [], [], "s", 0
    for stage, names in filters.PROGRAMS[name].items():
        for f in names:
            steps.append(f"t{i} AS MATERIALIZED ({FILTER_SQL[f].format(t=t)})")
            t, i = f"t{i}", i + 1
        parts.append(f"SELECT '{stage}' AS stage, pe, count(DISTINCT parent_id) AS n_fragments, count(*) AS n_slices FROM {t} GROUP BY pe")
    R.add(f"stage_stats_{name}", run, f"WITH {sql_clean()}, {', '.join(steps)} {' UNION ALL '.join(parts)}")


for _p in filters.PROGRAMS:
    _program(_p)
    _stage_stats(_p)


CUSTOM = """
mapped:
  - remove_unmapped_slices
  - remove_slices_without_re_frag_assigned
contains_capture:
  - remove_non_capture_fragments
  - remove_duplicate_re_frags
"""


@R.query(
    f"""WITH {sql_clean()}, a AS (SELECT * FROM s WHERE mapped = 1 AND restriction_fragment IS NOT NULL),
    b AS ({FILTER_SQL["remove_non_capture_fragments"].format(t="a")}), c AS ({FILTER_SQL["remove_duplicate_re_frags"].format(t="b")})
    SELECT slice_id, parent_id FROM c"""
)
def program_custom(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A program of one's own from YAML."""
    return filters.run_program(slices(spark, sf_dir), CUSTOM).select("slice_id", "parent_id")


@R.query(
    f"""WITH {sql_clean()} SELECT s.slice_id, v.viewpoint FROM s
    LEFT JOIN (SELECT parent_id, capture AS viewpoint FROM s WHERE capture_count = 1) v ON v.parent_id = s.parent_id"""
)
def slices_with_viewpoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.slices_with_viewpoint(slices(spark, sf_dir)).select("slice_id", "viewpoint")


@R.query(f"WITH {sql_clean()} SELECT capture_count = 1 AS captured, count(*) AS n, count(DISTINCT parent_id) AS n_fragments FROM s WHERE capture_count <= 1 GROUP BY 1")
def captures_and_reporters(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = slices(spark, sf_dir)
    both = filters.captures(s).withColumn("captured", F.lit(True)).unionByName(filters.reporters(s).withColumn("captured", F.lit(False)))
    return both.groupBy("captured").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("parent_id").alias("n_fragments"))
