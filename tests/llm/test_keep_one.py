"""The choice of one document per component keeps rows that are no near copies."""

from vulnlake.llm import golay

from tests.llm import brute

WORDS = ["red green blue white black", "one two three four five six", "mon tue wed thu fri sat", "do re mi fa sol la si"]


def test_rows_without_an_id_and_with_a_repeated_one(spark):
    data = [(None, w, "en", "s", 1) for w in WORDS[:2]] + [(None, WORDS[0], "en", "s", 1), (7, WORDS[2], "en", "s", 1), (7, WORDS[3], "en", "s", 1)]
    data += [(9, WORDS[2], "en", "s", 1), (7, WORDS[3].upper(), "en", "s", 1), (10, WORDS[2], "en", "s", 1), (None, WORDS[2], "en", "s", 1)]
    got = golay.keep_one(spark.createDataFrame(data, brute.DOCS)).collect()
    assert sorted(((r.doc_id, r.text.lower()) for r in got), key=str) == sorted(
        [(None, WORDS[0]), (None, WORDS[1]), (7, WORDS[2]), (7, WORDS[3])], key=str
    )
