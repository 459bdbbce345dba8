from gantry.operators import gold as build
from gantry.operators import kpis
from gantry.plans import gold
from gantry.plans.base import edges


def test_pairs_are_passed_once(spark):
    """The quantile and the greatest value are found over written figures: the touching pairs are not made anew for each."""
    sf_dir = "/root/testdata/sf0.001"
    met = spark.sparkContext.accumulator(0)

    def told(batches):
        for b in batches:
            met.add(b.num_rows)
            yield b

    plain = edges(spark, sf_dir).select("src", "dst")
    g = gold.written(gold.built(spark, sf_dir))
    found = build.zone_kpis(g, gold._zones(g), kpis.object_kpis(g, plain.mapInArrow(told, plain.schema)))
    assert found.count() > 0
    assert met.value == plain.count()
