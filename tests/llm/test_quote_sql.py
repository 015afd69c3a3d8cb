"""The SQL of the quotation threads against the operator where turns repeat."""
import duckdb
import pandas as pd

from plenum.llm import quote_threads
from plenum.llm.registry import SQL

ROWS = [(1, 0, "user", "ok"), (1, 1, "assistant", "first answer"), (1, 2, "user", "ok"), (1, 3, "assistant", "second answer"), (1, 4, "user", "ok"),
        (2, 0, "user", "one\ntwo\n\nthree"), (2, 1, "assistant", "two"), (2, 2, "user", "three"), (2, 3, "assistant", "Two!"), (2, 4, "user", None),
        (3, 0, "user", "thanks"), (3, 1, "user", "thanks"), (3, 2, "user", "thanks"), (3, 3, "user", "thanks")]


def test_latest_holder_in_both(spark):
    df = spark.createDataFrame(ROWS, "conv_id long, turn long, role string, text string")
    got = quote_threads.thread(quote_threads.mail_replies(df)).toPandas()
    con = duckdb.connect()
    con.register("conversations", pd.DataFrame(ROWS, columns=["conv_id", "turn", "role", "text"]))
    want = con.execute(SQL["op10_quote_threads"]).df()

    def plain(frame):
        return sorted(tuple(None if pd.isna(v) else v for v in r) for r in frame[sorted(frame.columns)].itertuples(index=False))

    assert str([tuple(str(v) for v in r) for r in plain(got.astype(object))]).replace(".0'", "'") == \
        str([tuple(str(v) for v in r) for r in plain(want.astype(object))]).replace(".0'", "'")
    replies = {(r.conv_id, r.turn): r.reply_to for r in got.itertuples()}
    assert replies[1, 3] == 2 and replies[3, 3] == 2
