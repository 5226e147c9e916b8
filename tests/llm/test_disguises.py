"""One planted document for each kind of disguise."""

import random

import numpy as np
import pytest

from fundscape.llm import toxicity

from .test_operators import frame, words

KINDS = {
    "sign at the end": ("that idio+ said", "idiot"), "short, signs at the end": ("an a$$ said", "ass"), "two signs at the end": ("so worthle$$ said", "worthless"), "sign inside": ("that 1d1ot said", "idiot"),
    "doubled": ("that iddiot said", "idiot"), "tripled": ("that looooser said", "loser"), "two blanks": ("that l  o  s  e  r", "loser"), "dashes with blanks": ("that l - o - s - e - r", "loser"),
    "slashes": ("that l/o/s/e/r", "loser"), "commas": ("that l, o, s, e, r", "loser"), "bars": ("that l|o|s|e|r", "loser"), "bars with blanks": ("that l | o | s | e | r", "loser"),
    "dots": ("that l.o.s.e.r", "loser"), "beyond ASCII": ("that l·o·s·e·r", "loser"), "euro": ("that los€r said", "loser"), "spaced euro": ("that l o s € r", "loser"),
}


def test_each_kind_of_disguise(spark):
    rng = random.Random(5)
    plain = "the worthless idiot was an ass and said that loser so worthless is the idiot as an ass and a loser said "
    docs = [(k, words(rng, 30) + (" " + ("idiot", "loser", "ass", "worthless")[k // 2 % 4] if k % 2 else " the was said that an so")) for k in range(200)] + [(500, plain * 60)]
    docs += [(1000 + k, f"{words(rng, 30)}\n{text}") for k, (text, _) in enumerate(KINDS.values())] + [(2000, "a\nb\nc"), (2001, "$"), (2002, "1 | 2 | 3")]
    labels = spark.createDataFrame([(k, k % 2) for k in range(200)], "doc_id long, toxic int")
    got = {r["doc_id"]: r for r in toxicity.score_toxicity(frame(spark, docs), labels).collect()}
    missed = [kind for k, (kind, (_, word)) in enumerate(KINDS.items()) if got[1000 + k]["score"] <= 0.5 or not any(word in s["text"].split() for s in got[1000 + k]["restored"])]
    assert not missed
    assert all(got[k]["score"] < 0.5 and not got[k]["restored"] for k in (2000, 2001, 2002))


@pytest.mark.parametrize(("text", "spans"), [("a$$", 1), ("good", 1), ("€ 5", 0), ("los€r", 1), ("a b", 0), ("a b c", 1), ("a  b , c", 1), ("x", 0)])
def test_flagged_spans(text, spans):
    low = np.frombuffer(text.encode(), np.uint8)
    assert len(toxicity.suspicious(low, np.array([0, len(low)]))) == spans
