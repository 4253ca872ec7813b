from pyspark.sql import functions as F

from topicloom.llm import language_cnn as N


def by_id(df):
    return {r.doc_id: r.language for r in df.collect()}


def corpus(documents, *more):
    rows = []
    for k in range(60):
        rows.append((k, f"über schön groß straße {'öffnen ' * (k % 7)}", "de"))
        rows.append((100 + k, f"the weather with another thing {'window ' * (k % 5)}", "en"))
    return documents(*rows, *more)


def test_learns_and_marks_held_out_rows(documents):
    found = N.identify(corpus(documents, (1000, "groß und schön, öffnen straße", None), (1001, "window weather thing with the", "de")))
    rows = found.select("doc_id", "lang", N.held_out(F.col("doc_id"), 4, 2).alias("apart"), "language").collect()
    assert {r.apart for r in rows} == {True, False}
    told = {r.doc_id: r.language for r in rows}
    wrong = [r for r in rows if r.doc_id < 1000 and r.language.lang_pred != r.lang]
    assert not wrong
    assert told[1000].lang_pred == "de" and told[1001].lang_pred == "en"
    assert all(0 <= r.language.score <= 1 for r in rows)


def test_odd_texts(documents):
    odd = [(2000, None), (2001, ""), (2002, "123 !? \n"), (2003, "ß"), (2004, "the " * 60_000), (None, "the weather"), (2005, "x", "en"), (2005, "x", "en")]
    found = N.identify(corpus(documents, *odd))
    assert found.columns == ["doc_id", "text", "lang", "source", "n_chars", "language"]
    told = by_id(found)
    assert [told[k].lang_pred for k in (2000, 2001, 2002)] == ["und"] * 3 and told[2000].score == 0
    assert told[2003].lang_pred == "de" and told[2004].lang_pred == "en" and told[None].lang_pred == "en"
    assert found.filter("doc_id = 2005").select("language").distinct().count() == 1


def test_no_labels_and_no_rows(documents):
    assert by_id(N.identify(documents((1, "abc"), (2, "def"))))[1].lang_pred == "und"
    assert N.identify(documents()).count() == 0


def test_later_windows_count(documents):
    """A long text is told by all of it: the first window is of the other language."""
    mixed = "the weather with another thing " * 8 + "über schön groß straße öffnen " * 400
    assert by_id(N.identify(corpus(documents, (3000, mixed))))[3000].lang_pred == "de"
