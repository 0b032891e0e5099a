import random

import pytest

from radiospark.operators import components


@pytest.fixture
def made(monkeypatch):
    """The labels of the tables that are written."""
    labels = []
    write = components.written
    monkeypatch.setattr(components, "written", lambda df, label: labels.append(label) or write(df, label))
    return labels


def found(spark, edges):
    return sorted(map(tuple, components.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()))


def test_stars_take_no_rounds(spark, made):
    edges = [(5, 1), (1, 7), (9, 8), (8, 9), (4, 4), (None, 3), (7, 1)]
    assert found(spark, edges) == [(5, 1), (7, 1), (9, 8)]
    assert made == ["edges"]


def test_a_round_that_leaves_stars_is_the_last(spark, made):
    assert found(spark, [(1, 2), (2, 3), (5, 2)]) == [(2, 1), (3, 1), (5, 1)]
    assert len(made) == 5


def test_components_against_a_plain_search(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(35)] + [(k, k + 1) for k in range(100, 130)] + [(200, k) for k in range(190, 210)] + [(None, 1), (2, None)]
    least = {x: x for e in edges if None not in e for x in e}
    for _ in least:
        for a, b in edges:
            if a is not None and b is not None:
                least[a] = least[b] = min(least[a], least[b])
    assert found(spark, edges) == sorted((x, c) for x, c in least.items() if x != c)
    assert found(spark, [(1, 1)]) == []
