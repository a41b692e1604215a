import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark():
    from locusloom.session import local_session, ship_package

    session = local_session("4", partitions=4, memory="4g")
    session.sparkContext.setLogLevel("ERROR")
    session.conf.set("spark.sql.adaptive.coalescePartitions.parallelismFirst", "false")
    ship_package(session)
    return session
