import pathlib
import sys

import pytest

ROOT = pathlib.Path(__file__).resolve().parent
sys.path[:0] = [str(ROOT.parent), str(ROOT)]

from postlane import prepare  # noqa: E402
from postlane.schemas import MESSAGES  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    from compare import session

    started = session()
    prepare(started)
    yield started
    started.stop()


@pytest.fixture
def make(spark):
    """Build messages from dicts; whatever is not given gets a plain default."""

    def build(*rows: dict, kind: str = "text"):
        full = []
        for at, row in enumerate(rows, 1):
            base = {
                "source": "QM1/DEV.QUEUE.1",
                "arrival_seq": at,
                "message_id": f"ID:{at:048x}",
                "destination": "queue:///DEV.QUEUE.1",
                "jms_timestamp": 1_700_000_000_000 + at,
                "body_kind": kind,
                "properties": [],
            }
            base.update(row)
            full.append(tuple(base.get(name) for name in MESSAGES.names))
        return spark.createDataFrame(full, MESSAGES)

    return build


def prop(name, kind, text=None, raw=None):
    return (name, kind, text, raw)
