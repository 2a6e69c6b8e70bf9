"""The options a JDBC catalog reads with. No database is at hand, so the reader is a stand-in."""

from types import SimpleNamespace

from quayside.sources.catalog import jdbc_catalog


class Reader:
    def __init__(self, said, columns, ends):
        self.said, self.columns, self.ends, self.given = said, columns, ends, {}

    def format(self, kind):
        assert kind == "jdbc"
        return self

    def options(self, **given):
        self.given |= given
        return self

    def load(self):
        self.said.append(dict(self.given))
        return SimpleNamespace(columns=self.columns, first=lambda: self.ends, options=self.given)


def opened(columns, ends, **more):
    said = []
    class Spark:
        conf = SimpleNamespace(set=lambda *a: None)
        read = property(lambda self: Reader(said, columns, ends))

    found = jdbc_catalog(Spark(), "jdbc:x", ["sale_order"], 8, **more)["sale_order"]
    return found, said


def test_ids_are_sliced_between_the_ends_the_database_tells():
    _, said = opened(["id", "name"], (-5, 1000))
    assert said[1]["query"] == "SELECT min(id) AS low, max(id) AS high FROM public.sale_order" and "dbtable" not in said[1]
    last = said[-1]
    assert (last["partitionColumn"], last["lowerBound"], last["upperBound"], last["numPartitions"]) == ("id", -5, 1001, 8)
    assert last["fetchsize"] == "10000"


def test_given_ranges_are_not_asked_for():
    _, said = opened(["id"], None, key_ranges={"sale_order": (1, 9)}, fetchsize="50")
    assert len(said) == 1 and said[0]["upperBound"] == 10 and said[0]["fetchsize"] == "50"


def test_without_ids_or_rows_there_is_one_slice():
    for columns, ends in ((["a_id", "b_id"], None), (["id"], (None, None))):
        _, said = opened(columns, ends)
        assert all("partitionColumn" not in s for s in said)
