"""One local session for all tests; fixtures that write asset packages."""

import json
import sys
import zipfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from assetlake.session import local_session  # noqa: E402
from assetlake.sources.scratch import remove_scratch  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session()
    session.conf.set("spark.sql.shuffle.partitions", "3")
    yield session
    remove_scratch(session)


def write_zip(path: Path, members: dict[str, str]) -> None:
    path.parent.mkdir(parents=True, exist_ok=True)
    with zipfile.ZipFile(path, "w") as archive:
        for name, body in members.items():
            archive.writestr(name, body)


def mapping(iid: str, name: str, transformations) -> str:
    return json.dumps({"content": {"$$IID": iid, "name": name, "transformations": transformations}})


def rows_of(frame, *columns):
    """Rows as sorted tuples."""
    if columns:
        frame = frame.select(*columns)
    return sorted((tuple(r) for r in frame.collect()), key=repr)
