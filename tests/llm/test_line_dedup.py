"""Repeated lines and passages against brute force, and edge cases."""

from pyspark.sql import functions as F

from wardflow.llm import line_dedup, queries

WORDS = queries.PASSAGE_WORDS


def form_of(piece):
    return " ".join(piece.lower().split())


def lines_of(text, by_sentence):
    """Per line the (start, end) of its sentences, found character by character; blank ones are left out."""
    at = 0
    for line in text.split("\n"):
        cuts = [0]
        for k in range(1, len(line)):
            begins_gap = line[k].isspace() and not line[k - 1].isspace()
            if by_sentence and begins_gap and line[k - 1] in ".!?":
                cuts.append(k)
        spans = []
        for i, j in zip(cuts, [*cuts[1:], len(line)]):
            piece = line[i:j]
            if piece.strip():
                lead = len(piece) - len(piece.lstrip())
                spans.append((at + i + lead, at + i + lead + len(piece.strip())))
        if spans:
            yield spans
        at += len(line) + 1


def brute(rows, passage_words=WORDS):
    """Removed units (doc_id, start, end, keep_doc_id, keep_start) of rows (doc_id, text) in order."""
    first, out = {}, []
    for k in sorted(range(len(rows)), key=lambda k: (rows[k][0] is None, rows[k][0] or 0, k)):
        key, text = rows[k][0], rows[k][1] or ""

        def is_repeat(start, end):
            return first.setdefault(form_of(text[start:end]), (key, k, start)) != (key, k, start)

        found = []  # start, end, whether a repeat, whether of a repeated line
        for spans in lines_of(text, passage_words is not None):
            whole = is_repeat(spans[0][0], spans[-1][1])
            found += [(a, b, is_repeat(a, b), whole) for a, b in spans]
        every = all(f[2] for f in found)
        for n, (a, b, repeat, whole) in enumerate(found):
            if not repeat:
                continue
            lo, hi = n, n + 1
            while lo and found[lo - 1][2]:
                lo -= 1
            while hi < len(found) and found[hi][2]:
                hi += 1
            forms = [form_of(text[i:j]) for i, j, _, _ in found[lo:hi]]
            size = sum(max(len(f.split()), len(f) // 5) for f in forms)
            if whole or every or (passage_words is not None and size >= passage_words):
                kept = first[form_of(text[a:b])]
                out.append((key, a, b, kept[0], kept[2]))
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r) for r in df.select("doc_id", "start", "end", "keep_doc_id", "keep_start").collect()), key=repr)


def test_units():
    text = "  One two.  Three!\n\n four\tfive? six 7.5 x"
    found = list(line_dedup.units(text))
    assert [text[a:b] for a, b, _ in found] == ["One two.", "Three!", "four\tfive?", "six 7.5 x"]
    assert found[2][2] == "four five?"


def test_same_as_brute_force(spark, sf_dir):
    docs = queries.documents(spark, sf_dir)
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    assert got(queries.op3_line_dedup(spark, sf_dir)) == brute(rows)
    assert got(line_dedup.repeats(docs)) == brute(rows, None)


PASSAGE = "This passage is repeated in many texts. It has more than twenty words in all, so that it has to go. Truly!"


def test_passage_within_lines_is_cut(table):
    docs = table([(1, f"A start. {PASSAGE} An end."), (2, f"Other start.\n{PASSAGE.upper()} Other end."), (3, "Truly! Nothing else.")], clash=True)
    left = {r["doc_id"]: (r["text"], [tuple(s) for s in r["kept_spans"]]) for r in line_dedup.without_repeats(docs, passage_words=WORDS).collect()}
    assert left[1][0] == f"A start. {PASSAGE} An end." and left[3][0] == "Truly! Nothing else."
    text, spans = left[2]
    original = f"Other start.\n{PASSAGE.upper()} Other end."
    assert text == "".join(original[a:b] for a, b in spans) and "PASSAGE" not in text and text.startswith("Other start.") and text.endswith("Other end.")


def test_whole_lines_go_whatever_their_length(table):
    rows = [
        (1, "All rights reserved.\nRead on! Or not.\nBody one. Yes. No."),
        (2, "All  Rights reserved.\nYes. No.\nread on! or not.\nBody two. All rights reserved."),
        (3, "No. Yes."),
        (4, "甲乙丙丁戊己庚辛壬癸" * 12 + "。\nx"),
        (5, "Intro. " + "甲乙丙丁戊己庚辛壬癸" * 12 + "。\ny"),
        (6, "Intro! " + "甲乙丙丁戊己庚辛壬癸" * 12 + "。\nz"),
    ]
    left = {r["doc_id"]: r["text"] for r in line_dedup.without_repeats(table(rows, clash=True), passage_words=WORDS).collect()}
    assert left[1] == rows[0][1] and left[4] == rows[3][1]
    assert left[2].split() == "Yes. No. Body two. All rights reserved.".split()
    assert left[3].strip() == "" and left[5].split() == ["Intro.", "y"] and left[6].split() == ["Intro!", "z"]


def test_no_later_whole_line_is_left(spark, sf_dir):
    seen = set()
    docs = queries.documents(spark, sf_dir).select("doc_id", "text")
    for r in line_dedup.without_repeats(docs).orderBy("doc_id").collect():
        for form in filter(None, map(form_of, (r["text"] or "").split("\n"))):
            assert form not in seen, (r["doc_id"], form)
            seen.add(form)


def test_edges(table):
    rows = [(1, None), (2, ""), (None, PASSAGE), (3, PASSAGE), (3, PASSAGE), (4, (PASSAGE + "\n") * 2000), (5, "short. " * 40)]
    docs = table(rows, clash=True).coalesce(1)
    assert got(line_dedup.repeats(docs)) == brute(rows, None)
    assert got(line_dedup.repeats(docs, passage_words=WORDS)) == brute(rows)
    assert line_dedup.repeats(table([])).count() == 0 and line_dedup.without_repeats(table([])).count() == 0
    assert line_dedup.without_repeats(docs).drop("kept_spans").columns == docs.columns
    assert line_dedup.without_repeats(docs).filter(F.col("text").isNull()).count() == 1
