import __spark_entry__ as entry
from transferlens.llm import queries


def test_all_thirteen_operators_are_registered():
    assert [n.split("_")[0] for n in queries.QUERIES] == [f"op{k}" for k in range(1, 14)]
    assert {*queries.QUERIES, "pipeline"} <= set(entry.queries())
