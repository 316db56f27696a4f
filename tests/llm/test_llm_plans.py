"""Plans of the operators for training data."""

from linecorpus.llm import queries


def plan(df) -> str:
    return df._jdf.queryExecution().toString().split("== Physical Plan ==")[1]


def test_pieces_and_languages_do_not_shuffle(spark, data):
    for name in ("p9_found", "p9_pieces", "p2_found"):
        assert "Exchange" not in plan(queries.queries()[name](spark, data)), name
    assert "Python" not in plan(queries.queries()["p9_pieces"](spark, data))


def test_no_products_of_tables(spark, data):
    for name, q in queries.queries().items():
        p = plan(q(spark, data))
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p, name


def test_terms_cross_the_network_as_partial_counts(spark, data):
    p = plan(queries.queries()["p4_terms"](spark, data))
    assert p.index("HashAggregate") < p.index("Exchange hashpartitioning(term") < p.index("MapInArrow")
