"""Main text on hostile pages, other scripts, misleading attributes, and against a plain parser."""

import html
import html.parser
import random
import time

import pytest

from vigiframe.llm import op5_html_blocks as blocks

PROSE = "This is the text of the day and it was for all of them to read in the house with the others. " * 4


@pytest.mark.parametrize("marks", ['data-title="A hidden gem"', 'class="social-policy"', 'class="comment-is-free article-body"', 'id="search-results"',
                                   "title='display:none is a rule'", 'data-class="ad"', 'class="adventure"', 'alt="class=sidebar"'])
def test_attributes_that_only_look_like_hints(marks):
    assert blocks.main_text(f"<body><div {marks}><p>{PROSE}</p></div></body>")[0] == PROSE.strip()


@pytest.mark.parametrize("marks", ["hidden", 'hidden=""', 'style="color:red; display : none"', "aria-hidden='true'", 'class="x ad"', "class=cookie-notice", "ID='ad-1'",
                                   'class="site-footer"', 'role="navigation"', 'class="social-share-buttons"', "class = sidebar"])
def test_attributes_that_are_hints(marks):
    assert blocks.main_text(f"<body><div {marks}><p>{PROSE}</p></div><p>{PROSE}x</p></body>")[0] == f"{PROSE}x"


@pytest.mark.parametrize("sentence", ["今天天气很好我们去公园散步然后回家吃饭。", "วันนี้อากาศดีมากเราไปเดินเล่นที่สวนสาธารณะ", "今日はとても良い天気ですから公園へ行きました。"])
def test_scripts_without_spaces(sentence):
    page = f"<body><div class=menu><a href=x>{sentence}</a></div><div><p>{sentence * 30}</p><p><a href=x>{sentence * 9}</a></p></div></body>"
    assert blocks.main_text(page)[0] == sentence * 30
    assert blocks.main_text(f"<article><p>{sentence * 30}</p></article>")[0] == sentence * 30


def test_language_without_stop_words():
    text = ("Ta strona nie ma takich słów. " * 20).strip()
    assert blocks.main_text(f"<body><p>{text}</p><p>Krótko.</p></body>")[0] == text
    assert blocks.main_text(f"<body><p>{text}</p><p>{PROSE}</p></body>")[0] == PROSE.strip()     # a block of known words is preferred


HOSTILE = ["<script ", "<a ", "<![CDATA[", '<a href="', "<a href='", "<!--", "<", "</", "<a \"'", '<a b="c>"', "<script>", "</p ", '<p class="x" ', '<a ">', "<a b='\">",
           "<style", "<div class=ad>", "<p class=ad>", "<li hidden>", "&", "<a>", "<article>"]


@pytest.mark.parametrize("piece", HOSTILE)
def test_hostile_pages_take_linear_time(piece):
    def seconds(size):
        page = piece * (size // len(piece))
        start = time.perf_counter()
        blocks.main_text(page)
        return time.perf_counter() - start

    assert seconds(400_000) < 5                     # a quadratic scan takes minutes


def test_quotes_and_unclosed_things():
    assert blocks.main_text(f'<article><a title="a > b">{PROSE}</a><p>{PROSE}</p></article>')[0].endswith(PROSE.strip())
    assert blocks.main_text(f'<article><p title="never closed>{PROSE}</p><p>{PROSE}</p></article>')[0] == f"{PROSE}{PROSE.strip()}"
    assert blocks.main_text(f"<article><p>{PROSE}</p><script>var x = '</p>'; </SCRIPT ><p>{PROSE}</p></article>")[0] == f"{PROSE}{PROSE.strip()}"
    assert blocks.main_text(f"<article><p>{PROSE}</p><!-- <p>no</p> --><![CDATA[no]]></article>")[0] == PROSE.strip()
    assert blocks.main_text("<article>" + "x" * 500_000)[0] == "x" * 500_000


class Plain(html.parser.HTMLParser):
    """Text of an article whose markup is well formed, by the library's parser."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.out, self.skipped = [], 0

    def handle_starttag(self, tag, attrs):
        marks = dict(attrs)
        if self.skipped or tag in ("aside", "script", "nav", "form") or marks.get("class") in ("ad", "share") or "hidden" in marks:
            self.skipped += tag not in blocks.VOID
        elif tag in blocks.BLOCK_TAGS or tag == "br":
            self.out.append(" ")

    def handle_endtag(self, tag):
        if self.skipped:
            self.skipped -= 1
        elif tag in blocks.BLOCK_TAGS:
            self.out.append(" ")

    def handle_data(self, data):
        if not self.skipped:
            self.out.append(data)


def test_well_formed_articles_equal_a_plain_parser():
    rng = random.Random(8)
    words = ["the", "of", "and", "gem", "hidden", "a&amp;b", "&#233;t&eacute;", "x < y", "\n", "it"]

    def text():
        return " ".join(rng.choice(words) for _ in range(rng.randrange(1, 30)))

    def element(depth):
        kind = rng.choice(["div", "section", "blockquote", "aside", "form", "nav"] if depth else ["p", "h2", "pre"])
        marks = rng.choice(["", "", "", ' class="ad"', ' data-x="ad > hidden"', " hidden", ' class="lead"', " class='share'"])
        inner = "".join(element(depth - 1) if depth else rng.choice([text(), f"<b>{text()}</b>", f"<i class='lead'>{text()}</i>"]) for _ in range(3))
        return f"<{kind}{marks}>{inner}</{kind}>"

    for _ in range(300):
        page = f"<html><body><article>{''.join(element(rng.randrange(4)) for _ in range(4))}</article></body></html>"
        plain = Plain()
        plain.feed(page)
        plain.close()
        got = [b.text for b in blocks.blocks_of(page)]
        assert " ".join(got).split() == "".join(plain.out).split()


def test_rows_with_clashing_columns(spark):
    page = f"<article><p>{PROSE}</p></article>"
    rows = spark.createDataFrame([(1, "u", page, "t", 5), (1, "u", page, "t", 5), (None, None, None, None, None), (2, "v", "", "", 0)],
                                 "page_id bigint, url string, html string, text string, n_chars bigint")
    got = sorted((str(r.page_id), r.text, r.n_chars) for r in blocks.extract(rows).collect())
    assert got == sorted([("1", PROSE.strip(), len(PROSE.strip()))] * 2 + [("2", "", 0), ("None", "", 0)])
