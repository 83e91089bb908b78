import os

from shelfline.session import clear_work, materialise, work_path


def test_work_tables_go_when_asked(spark):
    kept = os.path.dirname(work_path(spark, "any"))
    before = set(os.listdir(kept))
    df = materialise(spark.range(5), "numbers")
    assert df.count() == 5 and set(os.listdir(kept)) - before
    clear_work(spark)
    assert not [n for n in os.listdir(kept) if n.startswith("numbers-")]
