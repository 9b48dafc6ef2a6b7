"""Records and failures from one parse, in batch and as a stream."""

import io
from contextlib import redirect_stdout

from pyspark.sql import functions as F

from vitrine.operators.products import COLUMNS, extract_products, records_and_failures
from vitrine.plans.rendered import RULES, product_pages
from vitrine.sinks.write import read_failures, read_records, write_outcomes
from vitrine.sources import parse
from vitrine.sources.pages import quarantine, usable_pages

AS_OF = "2025-01-01"


def rows(df):
    return sorted(map(repr, df.collect()))


def some_pages(spark, data):
    part = spark.read.parquet(f"{data}/part.parquet").limit(60)
    return product_pages(part).selectExpr(
        "page_id", "url", "if(page_id % 5 = 0, NULL, html) AS html", "if(page_id % 7 = 0, 500, 200) AS status"
    )


def test_one_parse_gives_both(spark, data, tmp_path, monkeypatch):
    build = parse.TreeBuilder.build

    def broken(self, html):
        if "#11 " in html:
            raise RecursionError("too deep")
        return build(self, html)

    monkeypatch.setattr(parse.TreeBuilder, "build", broken)
    pages = some_pages(spark, data)
    found = records_and_failures(pages, RULES, AS_OF, extra={"shout": F.upper("name")})
    plan = io.StringIO()
    with redirect_stdout(plan):
        found.explain("formatted")
    assert plan.getvalue().split("\n\n")[0].count("MapInArrow") == 1
    write_outcomes(found, str(tmp_path / "out"))
    records = read_records(spark, str(tmp_path / "out"), found.schema)
    assert records.columns == [*COLUMNS, "shout"]
    assert rows(records.drop("shout")) == rows(extract_products(usable_pages(pages), RULES, AS_OF))
    assert records.filter("shout = upper(name)").count() == records.count() > 0
    failures = read_failures(spark, str(tmp_path / "out"), found.schema)
    assert rows(failures) == rows(quarantine(pages))
    assert failures.filter("reason like '%too deep%'").count() > 0


def test_a_repeated_batch_replaces_itself_only(spark, data, tmp_path):
    found = records_and_failures(some_pages(spark, data), RULES, AS_OF)
    path = str(tmp_path / "table")
    write_outcomes(found, path, 0)
    write_outcomes(found.filter("page_id < 20"), path, 1)
    before = rows(read_records(spark, path, found.schema))
    write_outcomes(found.filter("page_id < 20"), path, 1)
    assert rows(read_records(spark, path, found.schema)) == before
    assert read_failures(spark, path, found.schema).count() > 0


def test_only_good_or_only_failed_pages(spark, data, tmp_path):
    found = records_and_failures(some_pages(spark, data), RULES, AS_OF)
    for name, test in (("good", "reason IS NULL"), ("bad", "reason IS NOT NULL"), ("none", "page_id < 0")):
        write_outcomes(found.filter(test), str(tmp_path / name), 3)
        counts = [read(spark, str(tmp_path / name), found.schema).count() for read in (read_records, read_failures)]
        assert [c > 0 for c in counts] == [name == "good", name == "bad"]
