"""What the registered file jobs leave behind, beside their rows (which the oracle checks)."""

import glob

from tallyspark import registry as R
from tallyspark.sinks import files as FS
from tallyspark.sources.fixtures import Fixtures

SF = "/root/testdata/sf0.001"


def test_the_small_dimension_is_one_part_file(spark, tmp_path):
    path = FS.export_csv(Fixtures(spark, SF).disciplines.repartition(3), f"{tmp_path}/tsv", sep="\t", single_file=True)
    parts = glob.glob(f"{path}/part-*")
    assert len(parts) == 1
    lines = open(parts[0]).read().splitlines()
    assert lines[0] == "row_id\tdiscipline\tseason" and len(lines) == 6


def test_import_cases_are_all_there(spark):
    """The report files hold each case that the import must tell apart."""
    lines = Fixtures(spark, SF).report_lines
    names = R.SC.REPORT_COLUMNS[5:]
    assert len(names) == 24 and lines.filter(f"{names[7]} = 'bad'").count() and lines.filter(f"{names[2]} = ''").count()
    assert lines.filter("from_date = '1998-13-45'").count() and lines.filter("part = 2").count()
    twice = lines.filter("part > 0").groupBy(*R.SC.REPORT_KEYS).count().filter("count = 2")
    assert twice.count()
