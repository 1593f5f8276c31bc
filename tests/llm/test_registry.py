"""One query for each operator and the pipeline, with SQL wherever SQL can say it."""
import __spark_entry__ as entry


def test_every_operator_and_the_pipeline_are_registered():
    names = [n for n in entry.queries() if n.startswith("op") and n[2].isdigit()]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == [*range(1, 14)] and "pipeline" in entry.queries()
    without = {int(n[2:].split("_")[0]) for n in names if n not in entry.oracle_sql()}
    assert without == NOT_IN_SQL and "pipeline" not in entry.oracle_sql()


#: Tokenizers, learned models, eigenvectors, byte spans, the edited slot map and window fingerprints; their tests use plain versions,
#: laws of the result or held-out rows.
NOT_IN_SQL = {2, 4, 5, 6, 8, 9, 10, 12, 13}
