from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from windrow.session import build_session  # noqa: E402

DELIVERIES = [
    "100,1,0,1,Ann,Bo,Cy,4,0,4,0,0,NA,NA,NA,NA,Reds,Blues",
    "100,1,0,2,Ann,Bo,Cy,1,0,1,0,0,NA,NA,NA,NA,Reds,Blues",
    "100,1,0,3,Bo,Ann,Cy,0,0,0,0,1,caught,Bo,Di,NA,Reds,Blues",
    "101,1,0,1,Ann,Ed,Flo,0,0,0,0,1,bowled,Ann,NA,NA,Reds,Greens",
    "101,2,0,1,Ann,Ed,Flo,6,0,6,0,1,bowled,Ann,NA,NA,Reds,Greens",
]
HEADER = (
    "id,inning,over,ball,batsman,non_striker,bowler,batsman_runs,extra_runs,total_runs,"
    "non_boundary,is_wicket,dismissal_kind,player_dismissed,fielder,extras_type,"
    "batting_team,bowling_team"
)
MATCHES = [
    "100,Pune,04/18/08,Ann,Old Park,0,Reds,Blues,Reds,bat,Reds,runs,12,N,NA,U1,U2",
    "101,Delhi,04/19/08,Flo,New Park,0,Reds,Greens,Greens,field,Greens,wickets,NA,N,NA,U3,U4",
    "102,Goa,04/20/08,Gus,Bay Park,1,Blues,Greens,Blues,bat,Blues,runs,3,N,NA,U5,U6",
    "103,Agra,04/21/08,Hal,Top Park,0,Reds,Blues,Reds,bat,Reds,runs,7,N,NA,U7,",
]


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "windrow-tests",
        "local[4]",
        spark__sql__shuffle__partitions="4",
        spark__ui__enabled="false",
        spark__driver__memory="4g",
        spark__sql__warehouse__dir=os.path.join(
            os.environ.get("TMPDIR", "/tmp"), f"windrow-warehouse-{os.getpid()}"
        ),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def lines(spark):
    def make(rows):
        return spark.createDataFrame([(r,) for r in rows], "value string")

    return make


@pytest.fixture
def deliveries(lines):
    return lines(DELIVERIES)


@pytest.fixture
def matches(lines):
    return lines(MATCHES)


def values(df):
    return sorted(tuple(r) for r in df.collect())


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()
