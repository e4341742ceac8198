"""Row-wise operators against plain Python: extraction, rules, secrets."""

import hashlib
import random
import re
import string

import pytest

from shopcast.llm import catalog, extract, repetition, secret_scan

SMALL = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
ODD = [(None, "x y"), (1, None), (1, ""), (2, " \n\t "), (2, " \n\t "), (3, "a b c d e " * 400), (4, "w" * 300_000)]


def docs(spark, rows):
    """With extra columns that carry the results' names."""
    wide = [(*r, 1, True, "z", "z") for r in rows]
    return spark.createDataFrame(wide, "doc_id long, text string, n_words int, kept boolean, spans string, id string")


def base_rules(text):
    words = WORD.findall(text or "")
    seen = {}
    for i in range(len(words) - 4):
        seen.setdefault(tuple(words[i:i + 5]), []).append(i)
    covered = {k for at in seen.values() if len(at) > 1 for i in at for k in range(i, i + 5)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""),
            len(lines) - len(set(lines)), len(covered), failed)


def test_repetition_equals_brute_force(spark):
    source = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()] + ODD
    got = repetition.repetition(docs(spark, source)).collect()
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert sorted((str(r.doc_id), *(r[c] for c in names)) for r in got) == sorted(
        (str(i), *base_rules(t)) for i, t in source)
    assert not any(r.kept and r.base_failed for r in got)


def test_rules_keep_good_documents(spark):
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    good = catalog.op7_repetition(spark, SMALL).filter("not base_failed").join(labels, "doc_id").filter("quality = 1")
    assert good.count() > 30 and good.filter("not kept").count() == 0


def test_keep_good_returns_whole_rows(spark):
    source = docs(spark, ODD + [(9, "one two three four five six seven eight nine ten eleven.")])
    assert [r.doc_id for r in repetition.keep_good(source).select(source.columns).collect()] == [9]


def test_base_spans(spark):
    text = ('password = "abc12", PASSWD:hunter22 api-key=zzzzzz apikey: zzzzzz AKIA' + "Z" * 16
            + " AKIAZ " + "ab12" * 6 + " " + "f" * 23)
    assert secret_scan.base_spans(text) == [
        ("assign", m.start(), m.end()) for m in re.finditer(r"PASSWD:hunter22|apikey: zzzzzz", text)] + [
        ("access", text.index("AKIAZZ"), text.index("AKIAZZ") + 20), ("hex", text.index("ab12ab"), text.index("ab12ab") + 24)]


def entropy(s):
    from math import log2
    return -sum(s.count(c) / len(s) * log2(s.count(c) / len(s)) for c in set(s))


def test_windows_equal_plain_entropy():
    string = "aZ3kd9Qpx7Lm2Vt8Rw5Yc1aaaaaaaaaaaaaaaaaaaaaaaaaaaaa0b4Hn6Jf1Sg7Ue3Kq9"
    for limit in (3.0, 3.8, 4.2):
        inside = set()
        for i in range(len(string) - 19):
            if entropy(string[i:i + 20]) >= limit - 1e-9:
                inside.update(range(i, i + 20))
        got = {k for a, b in secret_scan.high_entropy(string, 20, limit) for k in range(a, b)}
        assert got == inside


def test_secrets_digest_and_allow_list(spark):
    key = "q8Zr3Lk0Wn5Tb7Xv2Md9Hc4J"
    rows = ODD + [(5, f"é key {key} end"), (6, "123e4567-e89b-12d3-a456-426614174000 this_is_a_long_name_of_a_function")]
    got = {(r.doc_id, r.spans): r for r in secret_scan.digest(secret_scan.secrets(docs(spark, rows))).collect()}
    assert (5, f"entropy:6:{6 + len(key)}") in got and (6, "") in got
    assert got[6, ""].base_sha256 == hashlib.sha256(b"").hexdigest()
    assert len(got) == len({(i, "") for i, _ in rows}) and (None, "") in got


@pytest.mark.parametrize("alphabet,missed", [
    ("0123456789abcdef", 0.01), ("0123456789ABCDEF", 0.01), (string.ascii_lowercase + string.digits, 0.01),
    (string.ascii_uppercase + string.digits, 0.01), (string.ascii_uppercase + "234567", 0.03),
    (string.ascii_letters + string.digits, 0.05), (string.ascii_letters + string.digits + "+/", 0.05)])
def test_random_keys_are_found(alphabet, missed):
    # keys without a digit look like words to the allow-list: 1.6 % of base32, 3 % of base62 at 20 characters
    rnd, scanner = random.Random(5), secret_scan.Scanner(secret_scan.Scan())
    for length in (20, 24, 32):
        keys = ["".join(rnd.choices(alphabet, k=length)) for _ in range(2000)]
        assert sum(not scanner(f"see {k} here") for k in keys) <= missed * len(keys), length


def test_words_with_numbers_are_no_keys():
    scanner = secret_scan.Scanner(secret_scan.Scan())
    for text in ("internationalization18", "my_function_name2_and_section3", "/home/user1/project2/src/main",
                 "responsibilities2024", "release-notes-v2-of-2024"):
        assert scanner(f"see {text} here") == []


def test_redaction_keeps_columns(spark):
    source = spark.createDataFrame([(1, "a token=abcdef12 b", 18), (2, None, 0)], "doc_id long, text string, n_chars long")
    assert [tuple(r) for r in secret_scan.redacted(source).collect()] == [(1, "a <assign> b", 12), (2, None, 0)]


@pytest.mark.parametrize("page,text", [
    (None, ""), ("", ""), ("plain &amp; text", "plain & text"),
    ("<body><nav><a href=x>menu</a></nav><article><h1>T</h1><p>one <b>two<br>three<p>four &lt;five"
     "</article><footer>f</footer>", "T\n\none two three\n\nfour <five"),
    ("<body><div class='ad'>buy</div><div><p>A long paragraph of text, in several words.</p><p>Another paragraph of"
     " text.</p></div><div id=comments><p>first comment, also in several words</p></div><script>var x='<p>';</script>",
     "A long paragraph of text, in several words.\n\nAnother paragraph of text."),
    ("<p>open <!-- c --> end", "open end"), ("<<p>x", "<\n\nx")])
def test_main_text(page, text):
    assert extract.main_text(page) == text


@pytest.mark.parametrize("name", [
    "overflow-hidden", "has-sidebar", "no-sidebar", "search-result", "comments-open", "sidebar", "layout search"])
@pytest.mark.parametrize("inner", ["article", "main", "div"])
def test_wrappers_of_the_article_stay(name, inner):
    parts = paragraphs(4, 200, "part")
    page = (f"<body><div class=site-footer><p>{'about us ' * 9}</p></div><div class='{name}'><{inner}><h1>Title</h1>"
            f"{''.join(f'<p>{x}</p>' for x in parts)}<figure><img src=x><figcaption>What it shows</figcaption></figure>"
            f"</{inner}></div><div id=comments class=post-comments><p>{'what a reader says ' * 80}</p></div></body>")
    assert extract.main_text(page).split("\n\n") == ["Title", *parts, "What it shows"]


def paragraphs(n, chars, name):
    return [(f"{name} {k} " + "some words of plain text " * chars)[:chars].strip() for k in range(n)]


@pytest.mark.parametrize("tag", ["div", "section", "td"])
@pytest.mark.parametrize("sizes", [(400, 400), (400, 300, 350, 390), (300, 420, 180)])
def test_article_in_several_containers(tag, sizes):
    parts = [paragraphs(5, c, f"part{i}") for i, c in enumerate(sizes)]
    inner = "".join(f"<{tag}>{''.join(f'<p>{x}</p>' for x in part)}</{tag}>" for part in parts)
    inner = f"<table><tr>{inner}</tr></table>" if tag == "td" else inner
    links = "".join(f"<li><a href=/{k}>more of this site {k}</a></li>" for k in range(9))
    page = (f"<body><div><ul>{links}</ul></div><div id=top><h1>The headline</h1></div><div>{inner}</div>"
            f"<div><ul>{links}</ul><p>All rights reserved.</p></div></body>")
    assert extract.main_text(page).split("\n\n") == ["The headline", *(x for part in parts for x in part)]


def test_extraction_of_all_pages(spark):
    import html
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SMALL}/pages.parquet").collect()}
    got = catalog.op2_extract(spark, SMALL).collect()
    assert len(got) == len(pages)
    for r in got:
        inner = re.search(r"<article>(.*)</article>", pages[r.page_id], re.S).group(1)
        parts = re.split(r"</?p>|</?h1>", re.sub(r"</?b>|<br>", " ", inner))
        blocks = [" ".join(html.unescape(x).split()) for x in parts]
        assert r.text == "\n\n".join(b for b in blocks if b) and r.n_chars == len(r.text)


def test_empty_tables(spark):
    none = docs(spark, ODD).limit(0)
    assert repetition.repetition(none).count() == 0
    assert secret_scan.digest(secret_scan.secrets(none)).count() == 0
    pages = spark.createDataFrame([], "page_id long, url string, html string, text string")
    assert extract.extract_text(pages).count() == 0
