import base64
import quopri

from hypothesis import given, settings
from hypothesis import strategies as st

from wellspring.llm import leakage as L
from wellspring.llm.mail import take_apart, words

ITEM = " ".join(f"Wort{i}, ärger{i}" for i in range(30)) + "."
HEAD = "From: A B <a@b.example>\nSubject: x\n"


def mails():
    run, short = " ".join(ITEM.split()[5:32]), " ".join(ITEM.split()[5:28])
    b64 = base64.encodebytes(("Hi,\n" + run).encode()).decode()
    qp = quopri.encodestring(run.upper().encode()).decode()
    lines = run.split()
    quoted = "\n".join("> > " + " ".join(lines[i : i + 5]) for i in range(0, len(lines), 5))
    html = "<html><body><p>" + " ".join(f"<b>{w.replace('ä', '&auml;')}</b>" for w in lines) + "</p></body></html>"
    multi = f'Content-Type: multipart/mixed; boundary="q"\n\n--q\nContent-Type: text/plain\n\nhello\n--q\nContent-Type: text/html\n\n{html}\n--q--\n'
    attached = f'Content-Type: multipart/mixed; boundary="q"\n\n--q\nContent-Type: application/octet-stream\nContent-Transfer-Encoding: base64\n\n{b64}\n--q--\n'
    return {
        1: (HEAD + "\n" + run, True), 2: (HEAD + "\n" + short, False), 3: (HEAD + "Content-Transfer-Encoding: base64\n\n" + b64, True), 4: (HEAD + "Content-Transfer-Encoding: quoted-printable\n\n" + qp, True),
        5: (HEAD + "\n" + quoted, True), 6: (HEAD + "Content-Type: text/html\n\n" + html, True), 7: (HEAD + multi, True), 8: (HEAD + attached, False), 9: ("", False), 10: (None, False), 11: (run, False),
        12: (HEAD + "\n" + "filler " * 50_000 + ITEM, True), 13: (HEAD + "\n" + run, True),
    }


def test_every_encoding_and_no_more(spark):
    docs = spark.createDataFrame([(i, t, 0) for i, (t, _) in mails().items()], "doc_id long, text string, item_id int")
    items = spark.createDataFrame([(1, ITEM, "a"), (2, "too short to leak", "b"), (3, None, "c"), (4, ITEM, "d")], "item_id long, text string, doc_id string")
    got = {(r.doc_id, r.item_id) for r in L.find_leaks(docs, items, "doc_id", "text", "item_id", "text").collect()}
    assert got == {(i, k) for i, (_, hit) in mails().items() if hit for k in (1, 4)}
    assert L.find_leaks(docs.limit(0), items, "doc_id", "text", "item_id", "text").count() == 0
    assert L.find_leaks(docs, items.limit(0), "doc_id", "text", "item_id", "text").count() == 0


def test_several_passes_give_the_same(spark, monkeypatch):
    docs = spark.createDataFrame([(i, t) for i, (t, _) in mails().items()], "doc_id long, text string")
    items = spark.createDataFrame([(k, ITEM) for k in range(6)], "item_id long, text string")
    one = sorted(L.find_leaks(docs, items, "doc_id", "text", "item_id", "text").collect())
    monkeypatch.setattr(L, "ITEM_CHARS", 500)
    assert sorted(L.find_leaks(docs, items, "doc_id", "text", "item_id", "text").collect()) == one


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from("abc"), max_size=60), st.lists(st.lists(st.sampled_from("abc"), max_size=12), max_size=4), st.integers(2, 6))
def test_search_equals_brute_force(text, texts, run):
    items = list(enumerate(texts))
    shift, bucket = L.shift_tables(items, run)
    got = L.find_items(text, items, shift, bucket, run)
    runs = {tuple(text[i : i + run]) for i in range(len(text) - run + 1)}
    assert set(got) == {k for k, w in items if any(tuple(w[i : i + run]) in runs for i in range(len(w) - run + 1))}
    for k, (place, size) in got.items():
        w = dict(items)[k]
        assert any(text[place : place + run] == w[i : i + run] for i in range(len(w))) and size >= run


def test_structure_of_mails():
    assert take_apart("no blank line")["missing"] == "headers"
    assert take_apart(mails()[7][0])["missing"] is None and take_apart(mails()[7][0][:-6])["missing"] == "multipart"
    assert take_apart(mails()[6][0][:-8])["missing"] == "html"
    assert words("Straße STRASSE e-mail_x 42") == ["strasse", "strasse", "e", "mail", "x", "42"]
