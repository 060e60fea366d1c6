import random
import re

from helpers import documents, with_clashing

from yieldlens.llm.substrings import remove_repeats


def brute(rows, window):
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    least = -(2**63)
    starts = {}
    for (i, _), w in zip(rows, words):
        for s in range(len(w) - window + 1):
            key = (least if i is None else i, s)
            k = tuple(w[s : s + window])
            starts[k] = min(starts.get(k, key), key)
    out = []
    for (i, _), w in zip(rows, words):
        gone = set()
        for s in range(len(w) - window + 1):
            if starts[tuple(w[s : s + window])] != (least if i is None else i, s):
                gone.update(range(s, s + window))
        out.append((i, len(w), len(gone), " ".join(x for n, x in enumerate(w) if n not in gone)))
    return sorted(out, key=str)


def some_rows():
    r = random.Random(11)
    vocabulary = ["a", "b", "ab", "é", "日本", "c\u00a0d", "x"]
    passage = " ".join(r.choices(vocabulary, k=12))
    rows = []
    for i in range(120):
        text = "".join(w + r.choice([" ", "\n", "\t ", "  "]) for w in r.choices(vocabulary, k=r.randint(0, 60)))
        rows.append((r.randint(0, 10**6) * 200 + i, text + (passage if i % 3 == 0 else "") + r.choice(["", " z"])))
    return rows + [(5, None), (7, ""), (9, " \n"), (11, "a " * 400), (13, rows[0][1]), (15, "b " * 3)]


def test_against_brute_force(spark):
    rows = some_rows()
    for window in (3, 8):
        found = remove_repeats(with_clashing(documents(spark, rows)).repartition(6), window=window)
        assert sorted((tuple(r) for r in found.collect()), key=str) == brute(rows, window)


def test_equal_ids_and_null_ids(spark):
    rows = [(1, "a b c d e"), (1, "a b c d e"), (1, "x a b c d"), (None, "a b c d"), (2, "d e f a b c")]
    found = remove_repeats(documents(spark, rows), window=3)
    assert sorted((tuple(r) for r in found.collect()), key=str) == brute(rows, 3)


def test_spacing_stays(spark):
    docs = documents(spark, [(1, "a b c\nd"), (2, "  x\ny\n\na b c\n\nz "), (3, "\n q \n")])
    found = {r["doc_id"]: (r["kept"], r["lang"]) for r in remove_repeats(docs, window=3, spaces=True).collect()}
    assert found == {1: ("a b c\nd", None), 2: ("x\ny\n\nz ", None), 3: ("\n q \n", None)}


def test_empty(spark):
    assert remove_repeats(documents(spark, [])).count() == 0


def test_long_document(spark):
    text = " ".join(f"w{i}" for i in range(120_000))
    rows = [(1, text), (2, text + " tail")]
    found = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept"]) for r in remove_repeats(documents(spark, rows)).collect()}
    assert found[1][:2] == (120_000, 0)
    assert found[2] == (120_001, 120_000, "tail")


def test_windows_are_done_before_texts_are_shuffled(spark):
    rows = [(1, "a b c d e"), (2, "x a b c d")]
    found = remove_repeats(documents(spark, rows), window=3)
    # what is left reads the stored intervals: the windows' shuffle files need not lie beside those of the texts
    assert "GroupsInArrow" not in found._jdf.queryExecution().toString()
    assert sorted((tuple(r) for r in found.collect()), key=str) == brute(rows, 3)
