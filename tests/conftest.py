import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from basketry.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[4]", **{
        "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "4g",
    })
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def documents(spark, tmp_path_factory):
    """The five entities read back from pretty-printed JSON arrays, sessions in two files."""
    import json

    from basketry.sources.documents import load
    from tests import fixtures as fx

    folder = tmp_path_factory.mktemp("documents")
    for name in ("users", "categories", "products", "transactions"):
        (folder / f"{name}.json").write_text(json.dumps(getattr(fx, name.upper()), indent=2))
    (folder / "sessions_0.json").write_text(json.dumps(fx.SESSIONS[:4], indent=2))
    (folder / "sessions_1.json").write_text(json.dumps(fx.SESSIONS[4:], indent=2))
    return load(spark, str(folder))


@pytest.fixture(scope="session")
def retail(documents):
    from basketry.sources.documents import DocumentRetail

    return DocumentRetail(documents)


@pytest.fixture
def rows():
    def collect(df, *columns):
        return [tuple(float(v) if type(v).__name__ == "Decimal" else v for v in r) for r in (df.select(*columns) if columns else df).collect()]

    return collect
