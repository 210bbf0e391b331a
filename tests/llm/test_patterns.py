import random

from pyspark.sql import functions as F

from chromaloom.llm import patterns as p

DIMS = ["bam", "day"]


def rows(seed=2, n=2000):
    r = random.Random(seed)
    return [(r.choice(["a", "b", None]), r.choice(["1", "2", "3"]), None if r.random() < 0.05 else f"i{r.randrange(300)}") for _ in range(n)]


def build(spark, data):
    df = spark.createDataFrame(data, "bam string, day string, identifier string")
    cells, seed = p.cells_of(df, DIMS)
    members = p.memberships(df, "identifier", p.cell_code(DIMS, seed))
    return df, cells, members


def test_every_answer_is_exact(spark):
    data = rows()
    _, cells, members = build(spark, data)
    totals = p.pattern_totals(members)
    named = {r.cell: (r.bam, r.day) for r in cells.collect()}
    per = {named[r.cell]: r.n_distinct for r in p.distinct_per_cell(totals).collect()}
    assert per == {k: len({i for b, d, i in data if (b, d) == k and i}) for k in named.values()}
    for dims in (["bam"], ["day"], ["bam", "day"]):
        got = {tuple(r[d] for d in dims): r.n_distinct for r in p.distinct_per(totals, cells, dims).collect()}
        at = [DIMS.index(d) for d in dims]
        want = {}
        for row in data:
            if row[2]:
                want.setdefault(tuple(row[j] for j in at), set()).add(row[2])
        assert got == {k: len(v) for k, v in want.items()}
    code = {v: k for k, v in named.items()}
    cell = lambda *ks: F.array(*[F.lit(code[k]) for k in ks])
    sets = {k: {i for b, d, i in data if (b, d) == k and i} for k in code}
    x, y, z = ("a", "1"), ("b", "2"), (None, "3")
    assert p.combination(totals, any_of=cell(x, y)).first()[0] == len(sets[x] | sets[y])
    assert p.combination(totals, all_of=[cell(x), cell(y)], none_of=cell(z)).first()[0] == len((sets[x] & sets[y]) - sets[z])


def test_parts_merge(spark):
    data = rows(5)
    df, cells, members = build(spark, data)
    code = p.cell_code(DIMS, p.cells_of(df, DIMS)[1])
    parts = [p.memberships(df.where(F.col("day") == d), "identifier", code) for d in ("1", "2", "3")]
    flat = lambda m: {(r.identifier, tuple(sorted(r.cells))) for r in m.collect()}
    assert flat(p.merge_memberships(parts)) == flat(members)
    shards = [p.pattern_totals(members.where(F.pmod(F.hash("identifier"), F.lit(3)) == k)) for k in range(3)]
    total = lambda t: {(tuple(r.cells), r.n) for r in t.collect()}
    assert total(p.merge_totals(shards)) == total(p.pattern_totals(members))


def test_empty_and_hot(spark):
    _, cells, members = build(spark, [])
    assert cells.count() == members.count() == 0 and p.combination(p.pattern_totals(members)).first()[0] == 0
    _, _, hot = build(spark, [("a", str(i % 3), "hot") for i in range(3000)] + [("a", "1", f"i{i}") for i in range(500)])
    assert hot.where("identifier = 'hot'").first().cells.__len__() == 3
