"""Line templates: keys found without passages, and templates counted by texts after a first count by rows."""
import numpy as np
import pyarrow as pa

from covlens.llm import line_templates as T

TEXTS = ["a b c 9 see://x\n\n" + "word " * 40 + "\nx", "", None, "é日 " * 14 + "\n9", "://", "one two three four five six seven eight nine ten 11 twelve"]


def test_known_templates_are_found_without_telling_passages():
    whole, quick = T.Lines(pa.array(TEXTS)), T.Lines(pa.array(TEXTS), passages=False)
    assert (whole.keys & np.uint64(1)).any()
    assert np.array_equal(quick.keys, whole.keys & ~np.uint64(1))
    assert np.array_equal(quick.number, whole.number) and np.array_equal(quick.row, whole.row)


def test_copies_of_one_text_do_not_make_its_lines_recurring(spark):
    line = "the same short line here"
    rows = [(i, f"{line}\nonly of the copies") for i in range(20)] + [(100 + i, f"{line}\nown words of {w} {w}x {w}y") for i, w in enumerate(("red", "blue", "gold", "grey"))]
    out = T.drop_recurring(spark.createDataFrame(rows, "doc_id long, text string"))
    got = {r.doc_id: (r.text, r.dropped) for r in out.collect()}
    assert all(got[i] == ("only of the copies", [0]) for i in range(20))
    assert got[100] == ("own words of red redx redy", [0])
    few = T.drop_recurring(spark.createDataFrame(rows[:-1], "doc_id long, text string"))
    assert all(r.dropped == [] for r in few.collect())
