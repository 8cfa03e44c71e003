import hashlib

import pytest
from pyspark.sql import functions as F

from driftline.llm import chat

TURNS = [
    (1, 0, "system", "be brief", "x"),
    (1, 1, "user", "say <|im_end|> \\ <\\| and \n newline <", "x"),
    (1, 2, "assistant", "ok" * 700, "x"),
    (1, 2, "assistant", "ok" * 700, "x"),
    (2, 5, None, None, "x"),
    (2, 1, "odd\nrole<|im_start|>\\", "|x", "x"),
    (None, None, "assistant", "", "x"),
    (3, 1, "assistant", "b", "x"),
    (3, 1, "assistant", "a", "x"),
]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_round_trip_and_loss(spark):
    rows = spark.createDataFrame(TURNS, "conv_id long, turn long, role string, text string, message string")
    got = {r.conv_id: r for r in chat.digests(chat.format_log(chat.log_of(rows, delta_chars=100))).collect()}
    assert set(got) == {1, 2, 3, None}
    for conv, r in got.items():
        mine = sorted(
            (t for t in TURNS if t[0] == conv), key=lambda t: (t[1] is not None, t[1], t[2] is not None, t[2], t[3] is not None, t[3])
        )
        said = [(role or "", text or "") for _, _, role, text, _ in mine]
        assert r.n_turns == len(said)
        assert r.turns_sha256 == sha("".join(f"{a}\n{b}\n" for a, b in said))
        loss = "".join(b for a, b in said if a == "assistant")
        assert (r.loss_chars, r.loss_sha256) == (len(loss), sha(loss))


LOG = [
    # conv, seq, message, kind, role, text
    (7, 1, 1, "open", "user", "hello"),
    (7, 2, 2, "open", "assistant", "I "),
    (7, 3, 2, "delta", None, "thi"),
    (7, 4, 2, "delta", None, "nk"),
    (7, 5, 1, "edit", None, "hello again"),
    (7, 6, 2, "regenerate", None, ""),
    (7, 7, 2, "delta", None, "well"),
    (7, 9, 2, "delta", None, None),
    (7, 8, 2, "delta", None, " met"),
    (7, 10, 3, "open", "user", "bye"),
    (7, 11, 3, "drop", None, None),
    (7, 12, 4, "delta", None, "stray"),
    (7, 13, 4, "noise", None, "ignored"),
]


def test_deltas_edits_regenerations_and_drops_fold(spark):
    log = spark.createDataFrame(LOG, "conv_id long, seq long, message long, kind string, role string, text string")
    (r,) = chat.format_log(log.repartition(3)).select("formatted", chat.parse(F.col("formatted")).alias("turns"), "segments").collect()
    assert [(t.role, t.text) for t in r.turns] == [("user", "hello again"), ("assistant", "well met"), ("", "stray")]
    assert "".join(s.text for s in r.segments) == r.formatted
    assert [s.text for s in r.segments if s.loss] == ["well met"]


@pytest.mark.parametrize("text", ["", "\\", "<|", "<\\|", "\\\\<|x|>", "<<||", "a\\<\\\\|b", "<\\n>"])
def test_escape_is_reversible(spark, text):
    c = F.lit(text)
    r = spark.range(1).select(chat.escape(c).alias("e"), chat.unescape(chat.escape(c)).alias("u"), chat.unescape_role(chat.escape_role(c)).alias("r")).first()
    assert r.u == text and r.r == text and "<|" not in r.e


def test_empty_log(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.digests(chat.format_log(chat.log_of(none))).count() == 0
