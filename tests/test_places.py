"""Places and running sums by ranges of an order."""

import collections

from pyspark.sql import functions as F

from helixmill.operators import places


def check(rows, key, value):
    groups = collections.defaultdict(list)
    for r in rows:
        groups[r[key] if key else None].append((r.place, value(r)))
    for g in groups.values():
        g.sort()
        assert [p for p, _ in g] == list(range(len(g))) and [v for _, v in g] == sorted(v for _, v in g)


def test_places_equal_those_of_a_sort(spark):
    d = spark.range(1000).select(F.expr("nullif(id % 3, 2)").alias("g"), F.expr("if(id % 3 = 0, 7, (id * 7919) % 1000)").alias("v"))
    check(places.placed(d, ["g"], [F.col("v").desc()], each=50).collect(), "g", lambda r: -r.v)
    check(places.placed(d, [], [F.col("v")], each=50).collect(), None, lambda r: r.v)
    assert {(r.g, r.total) for r in places.placed(d, ["g"], [F.col("v")], total="total").collect()} == {(0, 334), (1, 333), (None, 333)}
    for by in ([], ["g"]):
        assert places.placed(d.limit(0), by, [F.col("v")]).count() == 0


def test_one_value_makes_no_large_range(spark):
    d = spark.range(4000).select(F.lit(1).alias("v"))
    sizes = [r["count"] for r in places.ranges(d, [], [F.col("v")], each=100).groupBy("_part").count().collect()]
    assert len(sizes) > 30 and max(sizes) < 400 and sum(sizes) == 4000


def test_running_sums(spark):
    d = spark.range(300).select((F.col("id") % 2).alias("g"), F.col("id").alias("v"))
    for by in ([], ["g"]):
        ranged = places.ranges(d, by, [F.col("v")], each=40)
        starts = places.offsets(ranged, by, ("v",))
        rows = ranged.alias("a").join(starts.alias("b"), (F.col("a._part") == F.col("b._part")) & places.same("a", "b", by)).select("a.*", "_rows_v", "_all_v").collect()
        for r in rows:
            first = min(x.v for x in rows if x._part == r._part and (not by or x.g == r.g))
            own = [x for x in range(300) if not by or x % 2 == r.g]
            assert r._all_v == sum(own) and r._rows_v == sum(x for x in own if x < first)

        for r in places.summed(d, by, [F.col("v")], ("v",), each=40).collect():
            own = [x for x in range(300) if not by or x % 2 == r.g]
            assert (r.v_before, r.v_all, r.place, r.total) == (sum(x for x in own if x < r.v), sum(own), own.index(r.v), len(own))
