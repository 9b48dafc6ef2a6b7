import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from vitrine.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "local[4]", shuffle_partitions=4,
        **{"spark.checkpoint.dir": str(tmp_path_factory.mktemp("work"))},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def data():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def page(spark):
    """Page table from HTML strings."""
    def make(*sources, url="https://shop.example/p/{}.html"):
        rows = [(i, url.format(i), html) for i, html in enumerate(sources)]
        return spark.createDataFrame(rows, "page_id long, url string, html string")

    return make
