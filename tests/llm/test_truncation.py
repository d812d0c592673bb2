import base64

from wellspring.llm import truncation as T

HEAD = "From: Anna Kolrel <a@b.example>\nSubject: s\nContent-Type: text/plain\n"
BODY = "Hello Ben,\n\nWe compared the strange plates with the remaining calibration slides.\n\n"
SCHEMA = "doc_id long, source string, text string, place string"


def judge(spark, texts):
    filler = [(100 + i, "s", HEAD + "\n" + BODY + f"It was remaining number {i}.", "") for i in range(4)]
    rows = [(i, "s", t, "clash") for i, t in enumerate(texts)]
    found = T.find_truncated(spark.createDataFrame(rows + filler, SCHEMA), "doc_id", "text", "source").collect()
    return {r.doc_id: r for r in found if r.doc_id < 100}


def test_complete_and_cut_mails(spark):
    b64 = lambda t: HEAD + "Content-Transfer-Encoding: base64\n\n" + base64.b64encode(t.encode()).decode()
    complete = [
        BODY + "All is done.", BODY + "Is it?", BODY + "More tomorrow...", BODY + "Kind regards,\nAnna", BODY + "Viele Grüße\nAnna Kolrel", BODY + "Thanks", BODY + "Sent from my handset",
        BODY + "Cheers,\nAnna\n-- \nAnna Kolrel\nRoom X71628, Lane 64", BODY + "Cheers,", "Ok", "",
    ]
    cut = [BODY + "We will rem", BODY + "We wait for the", BODY + "The slide (blue", BODY + "Viele Gr�", "> quoted text that goes on and", BODY + "Kind regards,\nAnna Kolr"]
    raw_complete = [b64(BODY + "All done."), "Content-Type: text/html\n\n<html><p>a</p></html>", "Content-Transfer-Encoding: quoted-printable\n\nGr=C3=BC=C3=9Fe."]
    raw_cut = ["From: x\nSubject: y", b64(BODY + "All done.")[:-3], b64(BODY + "and then the"), "Content-Type: text/html\n\n<html><p>a</p></ht", "Content-Transfer-Encoding: quoted-printable\n\nGr=C3=BC=C", 'Content-Type: multipart/mixed; boundary="b"\n\n--b\nContent-Type: text/plain\n\nEnd.\n--b']
    texts = [HEAD + "\n" + t for t in complete + cut] + raw_complete + raw_cut
    want = [False] * len(complete) + [True] * len(cut) + [False] * len(raw_complete) + [True] * len(raw_cut)
    got = judge(spark, texts)
    assert [got[i].truncated for i in range(len(texts))] == want, [texts[i][-40:] for i in got if got[i].truncated != want[i]]
    assert got[len(complete)].word_cut and not got[len(complete) + 1].word_cut
    kinds = [got[i].evidence for i in range(len(complete), len(complete) + len(cut))]
    assert kinds == ["word", "phrase", "phrase", "word", "phrase", "phrase"]
    assert {got[i].evidence for i in range(len(texts) - len(raw_cut), len(texts)) if i != len(texts) - len(raw_cut) + 2} == {"structure"}


NAMES = [(200 + i, "s", HEAD + "\n" + BODY + "We met Mirrika Stovinde and said hello.", "") for i in range(3)]


def test_the_trie_of_words_decides(spark, monkeypatch):
    """A name that breaks off is cut only because its token begins a known word; without the trie it passes."""
    cut = [(1, "s", HEAD + "\n" + BODY + "Gracias,\nMirrika Stovi", "")]
    run = lambda: T.find_truncated(spark.createDataFrame(NAMES + cut, SCHEMA), "doc_id", "text", "source").filter("doc_id = 1").first()
    assert (run().evidence, run().place, run().word_cut) == ("word", "name", True)
    monkeypatch.setattr(T, "known_prefixes", lambda tokens, vocabulary: tokens.select("token").limit(0))
    assert run().evidence is None


def test_a_texts_own_last_token_is_no_vocabulary(spark):
    """Many texts cut within the same word do not make its beginning known."""
    cut = [(i, "s", HEAD + "\n" + BODY + f"We met {i} times with Mirrika Stovi", "") for i in range(9)]
    got = T.find_truncated(spark.createDataFrame(NAMES + cut, SCHEMA), "doc_id", "text", "source").filter("doc_id < 9").collect()
    assert [r.evidence for r in got] == ["word"] * 9


def test_the_trie_of_phrases_tells_closings_from_beginnings(spark):
    texts = ["The slides are here.", "The box is empty.", "Salut", "Salut", "The", "Bonne"]
    rows = [(i, "s", HEAD + "\n" + BODY + t, "") for i, t in enumerate(texts)]
    got = {r.doc_id: (r.place, r.evidence) for r in T.find_truncated(spark.createDataFrame(rows, SCHEMA), "doc_id", "text", "source").collect()}
    assert got[2] == got[3] == got[5] == ("closing", None) and got[4] == ("open", "phrase")


def test_length_decides_after_a_whole_word(spark):
    rows = [(i, "s", (HEAD + "\n" + BODY + f"It was remaining number {i} ").ljust(300, "x")[:291] + " remaining", "") for i in range(6)]
    rows += [(100 + i, "s", HEAD + "\n" + BODY + "The remaining slides. " * (i % 9 + 1), "") for i in range(60)]
    got = T.find_truncated(spark.createDataFrame(rows, SCHEMA), "doc_id", "text", "source").filter("truncated").collect()
    assert {(r.doc_id, r.evidence, r.word_cut) for r in got} == {(i, "length", False) for i in range(6)}


def test_nulls_empty_texts_and_empty_table(spark):
    df = spark.createDataFrame([(1, None, None, "x"), (2, None, "", "x"), (3, "s", HEAD + "\n" + "word " * 60_000, "x")], SCHEMA)
    got = {r.doc_id: (r.missing, r.truncated) for r in T.find_truncated(df, "doc_id", "text", "source").collect()}
    assert got == {2: ("headers", True), 3: (None, True)}
    assert T.find_truncated(df.limit(0), "doc_id", "text", "source").count() == 0


def test_prefixes_of_known_words(spark):
    tokens = spark.createDataFrame([("cal",), ("calib",), ("calibration",), ("calibrations",), ("x",), ("zz",), ("c",), (None,), ("",)], "token string")
    known = spark.createDataFrame([("calibration",), ("cell",), ("xy",)], "word string")
    assert sorted(r.token for r in T.known_prefixes(tokens, known).collect()) == ["c", "cal", "calib", "x"]


def test_lengths_that_pile_up(spark):
    rows = [("a", 1000, 1100 + i % 3) for i in range(12)] + [("a", 900 + 7 * i, 950 + 7 * i) for i in range(40)] + [("b", 1000, 1000)]
    got = {(r.source, r.unit, r.length) for r in T.length_limits(spark.createDataFrame(rows, "source string, n_chars long, n_bytes long")).collect()}
    assert got == {("a", "chars", 1000)}
