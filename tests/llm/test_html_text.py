import random
import time

import pytest

from leadloom.llm.html_text import blocks, extract, main_text

PROSE = "This is the story of a house that was built on the hill and it is told to all who come by the road in the evening"


def page(body):
    return f"<!DOCTYPE html><html><head><title>T</title></head><body>{body}</body></html>"


@pytest.mark.parametrize("around", [
    '<nav><ul><li><a href="/a">Home</a></li><li><a href="/b">News of the day</a></li></ul></nav>',
    '<div class="ad">Buy the best of it now.</div>',
    f'<aside><p>{PROSE} aside</p></aside>',
    f'<div class="cookie-notice"><p>{PROSE} cookies</p></div>',
    f'<form><label>{PROSE} form</label><input></form>',
    f'<section id="comments"><article class="comment"><p>{PROSE} reader</p></article></section>',
    f'<script>var a = "<p>{PROSE}</p>";</script><style>p {{}}</style><!-- {PROSE} -->',
    f'<footer><p>{PROSE} footer</p></footer>',
    f'<header><p>{PROSE} header</p></header>',
])
def test_surroundings_go(around):
    body = f"{around}<article><h1>Title</h1><p>{PROSE}.</p><p>Short.</p></article>{around}"
    assert main_text(page(body)) == f"Title\n{PROSE}.\nShort."


def test_without_article_rules_decide():
    html = page(f'<div><a href="/">Home</a> <a href="/x">More links</a></div><h2>Heading</h2><p>{PROSE}</p><p>{PROSE} again</p><p>So it is.</p>'
                '<div><a href="/1">one</a> | <a href="/2">two</a></div>')
    assert main_text(html) == f"Heading\n{PROSE}\n{PROSE} again\nSo it is."


def test_references_and_white_space():
    assert main_text(page("<article><p> a &amp; b\n\t &lt;c&gt; &#233;&nbsp;x<br>y <b>b</b>old </p></article>")) == "a & b <c> é x y bold"


@pytest.mark.parametrize("html, text", [
    (None, ""), ("", ""), ("   ", ""), ("<p", ""), ("<!-- never closed", ""), ("<script>x", ""),
    ("<article><p>cut &am", "cut &am"), ("<article><p>one<p>two</b></i></div></article>", "one\ntwo"),
    ('<article><p title="a > b">in</p><p title="x>out</p></article>', "in\nout"), ("a < b and c > d", "a < b and c > d"),
])
def test_broken_pages(html, text):
    assert main_text(html) == text


def test_junk_in_an_article_stays():
    junk = "XQZW!! ZZTP!! " * 20
    assert main_text(page(f"<article><p>{PROSE}</p><p>{junk}</p></article>")) == f"{PROSE}\n{junk.strip()}"


def test_large_and_deep_pages_take_linear_time():
    assert len(blocks("<div>" * 20_000 + "x" + "</b>" * 20_000)) == 1
    assert main_text('<a "' * 20_000) == ""
    assert len(main_text("<article>" + f"<p>{PROSE}</p>" * 5_000)) == 5_000 * (len(PROSE) + 1) - 1


def test_rows(spark, clashing):
    df = spark.createDataFrame([(1, "u", f"<article><p>{PROSE}</p></article>"), (1, "u", None), (None, None, "")],
                               "page_id BIGINT, url STRING, html STRING")
    rows = sorted(map(tuple, extract(clashing(df)).collect()), key=str)
    assert rows == [(1, "u", ""), (1, "u", PROSE), (None, None, "")]
    assert extract(df.limit(0)).collect() == []


SIMPLE = "the cat is on the mat and it was good to be there with us "


def test_a_page_wrapped_in_a_form_is_judged_by_its_controls():
    page = f"<form><input type=hidden name=s><p>{SIMPLE * 12}</p><p>{SIMPLE * 3}</p><input name=q></form>"
    assert main_text(page) == f"{(SIMPLE * 12).strip()}\n{(SIMPLE * 3).strip()}"
    fields = "<form><label>Name</label><input><p>" + SIMPLE * 4 + "</p><textarea>x</textarea></form>"
    assert main_text(fields) == ""
    assert main_text(f"<p>{SIMPLE * 5}</p>{fields}") == (SIMPLE * 5).strip()


def test_main_is_no_surrounding_by_its_class():
    assert main_text(f'<main class="modal-open"><p>{SIMPLE * 5}</p></main>') == (SIMPLE * 5).strip()
    assert main_text(f'<main hidden><p>{SIMPLE * 5}</p></main>') == ""


def test_languages_without_listed_stop_words():
    text = "это длинный русский текст о том как жили люди " * 8
    page = f"<div><a href=x>меню</a></div><div><p>{text}</p><p>коротко</p></div><div><a href=y>{text}</a></div>"
    assert main_text(page) == f"{text.strip()}\nкоротко"


def test_shared_elements_are_those_of_the_tree():
    rnd, paths, parts, number = random.Random(3), [], [], [0]

    def grow(path):
        for _ in range(rnd.randrange(1, 5)):
            if len(path) < 6 and rnd.random() < 0.6:
                number[0] += 1
                parts.append("<div>")
                grow((*path, number[0]))
                parts.append("</div>")
            else:
                number[0] += 1
                parts.append(f"<p>word{number[0]}</p>")
                paths.append((*path, number[0]))

    while len(paths) < 200:
        grow(())
    found = blocks("".join(parts))
    assert len(found) == len(paths)
    for i in range(len(paths)):
        low = len(paths)
        for j in range(i + 1, min(i + 30, len(paths))):
            low = min(low, found[j].shared)
            assert low == next((n for n, (x, y) in enumerate(zip(paths[i], paths[j])) if x != y), 0)


def test_deep_pages_of_many_blocks_take_time_in_proportion():
    def seconds(n):
        start = time.process_time()
        main_text("<div>text" * n)
        return time.process_time() - start

    seconds(100)
    assert seconds(40_000) < 30 * max(seconds(4_000), 0.02)
