from collections import defaultdict

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tierbed.operators import entity_counts, stamp_run

SCHEMA = "id string, country string, brewery_type string"
KEYS = ("country", "brewery_type")


def test_entity_counts(spark):
    data = [("1", "BR", "micro"), ("2", "BR", "micro"), ("2", "BR", "micro"), ("3", "BR", "brewpub")]
    data += [(None, "US", "micro"), (None, None, "nano"), ("9", None, "nano")]
    counts = entity_counts(spark.createDataFrame(data, SCHEMA), KEYS, out="n")
    assert [tuple(r) for r in counts.collect()] == [
        ("BR", "micro", 2),
        (None, "nano", 1),
        ("BR", "brewpub", 1),
        ("US", "micro", 0),
    ]


def test_stamped_gold(spark):
    df = spark.createDataFrame([("1", "BR", "micro")], SCHEMA)
    assert stamp_run(entity_counts(df, KEYS), "R1").first().asDict() == {
        "country": "BR", "brewery_type": "micro", "entity_count": 1, "ingestion_run_id": "R1"
    }


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(
        st.tuples(
            st.sampled_from([None, "1", "2", "3"]),
            st.sampled_from([None, "", "BR"]),
            st.sampled_from(["micro", "nano"]),
        ),
        max_size=25,
    )
)
def test_counts_against_brute_force(spark, data):
    want = defaultdict(set)
    for id, *keys in data:
        want[tuple(keys)] |= {id} - {None}
    got = entity_counts(spark.createDataFrame(data, SCHEMA), KEYS, out="n").collect()
    assert {(r.country, r.brewery_type): r.n for r in got} == {k: len(v) for k, v in want.items()}
    assert [r.n for r in got] == sorted((r.n for r in got), reverse=True)


def test_hot_group_and_hot_id(spark):
    """A third of the rows share one group, another third one id."""
    rows = [(str(i), "hot", "micro") for i in range(500)] + [("same", "BR", "micro")] * 500
    rows += [(str(i), f"c{i % 50}", "nano") for i in range(500)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(8)
    got = {r.country: r.entity_count for r in entity_counts(df, ("country",)).collect()}
    assert got == {"hot": 500, "BR": 1} | {f"c{i}": 10 for i in range(50)}
