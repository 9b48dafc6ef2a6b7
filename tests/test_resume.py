"""Category runs that are stopped and resumed."""

import pytest

from vitrine.plans import catalogue
from vitrine.plans.rendered import RULES, categories, category_pages, product_pages

AS_OF = "2025-01-01"


def rows(df):
    return sorted(map(repr, df.collect()))


@pytest.fixture(scope="module")
def shop(spark, data):
    part = spark.read.parquet(f"{data}/part.parquet")
    return catalogue.union_runs(product_pages(part), category_pages(part)), categories(part)


@pytest.fixture(scope="module")
def whole(shop):
    pages, seeds = shop
    return rows(catalogue.extract_category(pages, seeds, RULES, 2, AS_OF))


def test_stopped_and_resumed(spark, shop, whole, tmp_path):
    pages, seeds = shop
    root = str(tmp_path / "run")
    first = catalogue.resume_catalogue(pages, seeds, RULES, root, AS_OF, 2, parts=3, at_most=1)
    assert 0 < first["finished"] and 0 < first["left"]
    with pytest.raises(ValueError):
        catalogue.read_catalogue(spark, root)
    assert not (tmp_path / "run" / "parquet").exists()
    finished = {r.category for r in catalogue.finished_categories(spark, root).collect()}
    second = catalogue.resume_catalogue(pages, seeds, RULES, root, AS_OF, 2, parts=3)
    assert second == {"finished": seeds.count(), "left": 0}
    assert rows(catalogue.read_catalogue(spark, root).select(catalogue.extract_category(pages, seeds, RULES).columns)) == whole
    # finished categories were not done again, and a call after the end changes nothing
    log = catalogue.finished_categories(spark, root).collect()
    assert len(log) == seeds.count() and finished < {r.category for r in log}
    assert catalogue.resume_catalogue(pages, seeds, RULES, root, AS_OF, 2, parts=3) == second
    assert rows(catalogue.read_catalogue(spark, root)) == whole


def test_cut_off_inside_a_part(spark, shop, whole, tmp_path, monkeypatch):
    """A crash after staging and before logging, and one while parts are made visible."""
    pages, seeds = shop
    root = str(tmp_path / "run")
    real = catalogue.extract_category
    seen = []

    def fails_once(*args):
        seen.append(1)
        if len(seen) == 2:
            real(*args).write.parquet(f"{root}/_staged/part-left-behind")
            raise RuntimeError("stopped")
        return real(*args)

    monkeypatch.setattr(catalogue, "extract_category", fails_once)
    with pytest.raises(RuntimeError):
        catalogue.resume_catalogue(pages, seeds, RULES, root, AS_OF, 2, parts=2)
    move, moved = catalogue.Folder.move_to, []

    def moves_once(self, target):
        if moved:
            raise OSError("stopped")
        moved.append(target)
        move(self, target)

    monkeypatch.setattr(catalogue.Folder, "move_to", moves_once)
    with pytest.raises(OSError):
        catalogue.resume_catalogue(pages, seeds, RULES, root, AS_OF, 2, parts=2)
    monkeypatch.setattr(catalogue.Folder, "move_to", move)
    assert catalogue.resume_catalogue(pages, seeds, RULES, root, AS_OF, 2)["left"] == 0
    assert rows(catalogue.read_catalogue(spark, root)) == whole


def test_nothing_to_do(spark, shop, tmp_path):
    pages, seeds = shop
    root = str(tmp_path / "run")
    assert catalogue.resume_catalogue(pages, seeds.limit(0), RULES, root, AS_OF) == {"finished": 0, "left": 0}
