import dataclasses

import pytest

from logweir.plans import log_types
from logweir.session import build_session
from logweir.sources.configs import Field, LogConfig

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "logweir-tests", master="local[4]",
        **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "4g"},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture
def config():
    """A LogConfig of one of the known types in a database named after the test's folder."""

    def make(log_type: str, database: str, extra=(), **changes) -> LogConfig:
        doc = log_types.document(log_type, extra)
        fields = tuple(Field(f["name"], f["type"], f["required"]) for f in doc["fields"])
        made = LogConfig(
            name=doc["name"],
            log_type=log_type,
            topic=doc["kafka"]["topic"],
            table=f"{database}.{log_type}",
            fields=fields,
            partition_by=tuple(doc["warehouse"].get("partition_by", ())),
            sort_by=tuple(doc["warehouse"].get("sort_by", ())),
            retention_days=doc["warehouse"].get("retention_days"),
        )
        return dataclasses.replace(made, **changes)

    return make


@pytest.fixture
def database(request):
    """A database name of the test's own."""
    return "t_" + "".join(c if c.isalnum() else "_" for c in request.node.name.lower())[:60]
