"""What the runs of frames tell."""

from feedkit.catalog.oracles import ORACLES
from feedkit.catalog.queries import QUERIES
from helpers import tuples
from oracle_check import connect

SF = "/root/testdata/sf0.001"


def test_runs_tell_what_they_hold_and_how_they_ended(spark):
    told, status = QUERIES["inflight_runs"](spark, SF), QUERIES["run_status"](spark, SF)
    own = ["port", "uuid", "run_start", "total", "seen", "dups", "state"]
    assert {*own, "followed", "frames", "bytes"} == set(told.columns)
    assert tuples(told, *own) == tuples(status, *own)
    assert {r["state"] for r in told.select("state").distinct().collect()} >= {"complete", "abandoned"}
    assert told.filter("state = 'abandoned' AND NOT followed").isEmpty()
    assert told.filter("frames <> seen + dups").isEmpty()


def test_the_sql_of_runs_has_every_column_of_their_status():
    con = connect(SF)
    columns = [set(con.execute(ORACLES[n]).df().columns) for n in ("inflight_runs", "run_status")]
    assert columns[1] < columns[0]
