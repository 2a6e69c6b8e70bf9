from quayside.session import settings_for


def test_partitions_grow_with_the_input():
    gb = 1 << 30
    count = lambda size: int(settings_for(size, 8)["spark.sql.shuffle.partitions"])
    width = lambda size: int(settings_for(size, 8)["spark.sql.adaptive.advisoryPartitionSizeInBytes"])
    assert (count(gb), width(gb)) == (16, 128 << 20)
    assert (count(1024 * gb), width(1024 * gb)) == (8192, 128 << 20)
    assert count(100 * 1024 * gb) <= 100_000 and 1 << 30 <= width(100 * 1024 * gb) < 1200 << 20
