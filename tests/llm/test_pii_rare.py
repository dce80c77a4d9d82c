"""Entities that the corpus has in one or two lines."""

from voicegrid.llm import pii


def test_name_beside_an_only_address(spark):
    rows = [(i, f"plain words number {'abcdefghij'[i % 10]} here and there") for i in range(300)]
    rows += [(1000, "Zorblatt writes plain words from zed@corp.org\nand so on, plain words"), (1001, "plain words from Quixmere, ann@corp.org"), (1002, "Quixmere says plain words to ann@corp.org")]
    out = {r.doc_id: r.text for r in pii.sanitised(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(out[i] == t for i, t in rows[:300])
    assert not any(name in out[i] for i in (1000, 1001, 1002) for name in ("Zorblatt", "Quixmere", "@"))
    assert all("plain words" in out[i] for i in (1000, 1001, 1002))
