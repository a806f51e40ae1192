import pytest
from oracle import same

from folioforge.plans import catalogue

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query(spark, name):
    if name in catalogue.ORACLE:
        assert same(spark, catalogue.QUERIES[name], catalogue.ORACLE[name], SF) > 0
    else:
        assert catalogue.QUERIES[name](spark, SF).count() > 0


def test_entry_points():
    import __spark_entry__ as entry

    assert set(catalogue.QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_pages_are_drawn_a_few_at_a_time(spark, monkeypatch):
    import pyarrow as pa

    class Keys:
        """A table that keeps the functions which would draw it."""

        drawn = []

        def select(self, *_):
            return self

        def repartition(self, *_):
            return self

        def mapInArrow(self, run, _):
            self.drawn.append(run)
            return self

    monkeypatch.setattr(catalogue, "table", lambda *_: Keys())
    monkeypatch.setattr(catalogue.areas, "text_boxes", lambda pages: pages)
    catalogue.drawn_pages(spark, SF)
    catalogue.text_area(spark, SF)
    keys = pa.RecordBatch.from_pydict({"page_id": list(range(1000)), "p_size": [5] * 1000})
    for run in Keys.drawn:
        sizes = [b.num_rows for b in run(iter([keys]))]
        assert sum(sizes) == 1000 and max(sizes) <= 64
    assert len(Keys.drawn) == 2
