"""Main text where nothing but the rules can tell: no article element, other scripts, deep nesting."""

from __future__ import annotations

import re
import time
from collections import Counter

import pyarrow.parquet as pq

from wardmill.llm import main_text as H

PAGES = "/root/testdata/sf0.01/pages.parquet"
MENU = "<ul><li><a href='/a'>Home page</a><li><a href='/b'>All of the news</a></ul>"
PROSE = {
    "Russian": "Совет города решил в среду построить новый мост через реку, потому что старый больше не выдерживает движения. Работы начнутся весной "
               "и продлятся около двух лет, сообщил мэр на заседании, где присутствовали жители всех районов и представители предприятий.",
    "Chinese": "市议会星期三决定在河上修建一座新桥，因为旧桥已经无法承受日益增加的交通。" * 8,
    "Polish": "Rada miasta postanowiła zbudować nowy most przez rzekę, ponieważ stary jest zbyt słaby. Prace rozpoczną się wiosną, potrwają dwa lata, "
              "powiedział burmistrz podczas posiedzenia, gdzie byli obecni mieszkańcy wszystkich dzielnic oraz przedstawiciele przedsiębiorstw, szkół, szpitali. "
              "Koszty pokryje województwo, natomiast utrzymanie przejmie gmina, zgodnie z umową podpisaną zeszłej jesieni przez obie strony.",
}


def test_prose_without_a_list_of_stop_words():
    for text in PROSE.values():
        assert H.main_text(f"<body><div>{MENU}</div><div><p>{text}</p></div><div>{MENU}</div>") == text


def test_words_without_stop_words_beside_english_prose_are_not_prose():
    english = "The council of the city has decided that it will build a new bridge over the river, as the old one is too weak for what it has to carry. " * 3
    keywords = "bridge river council budget traffic concrete steel engineer mayor district tunnel railway harbour station market tower square garden museum"
    assert H.main_text(f"<div>{MENU}<p>{english}</p><p>{keywords}</p></div>") == english.strip()


def test_paragraph_or_item_that_is_one_link_stays_in_its_article():
    page = f"<nav>{MENU}</nav><article><p>Short.</p><p><a href='/r'>Read the full report of the council</a></p><ul><li><a href='/s'>Second source</a></ul></article>"
    assert H.main_text(page) == "Short.\nRead the full report of the council\nSecond source"


def test_deep_nesting_takes_time_in_proportion():
    n = 100_000
    began = time.monotonic()
    assert len(H.main_text("<article>" + "<div>word " * n + "</span></i>" * n)) == 5 * n - 1
    assert H.main_text("".join(f"<div class=related id=r{i}>word " for i in range(n))) == ""
    assert time.monotonic() - began < 60


def test_rules_alone_on_the_given_pages():
    """The same pages without article and main elements, names and roles. Their words are made up, so that stop words are rarer than in
    prose: of the article's blocks at least 80 % are found, and at least 97 % of what is found is the article's."""
    whole, alone = Counter(), Counter()
    for i, page in enumerate(pq.read_table(PAGES).column("html").to_pylist()):
        plain = re.sub(r"""\s(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>]*)""", "", re.sub(r"<(/?)(article|main)\b", r"<\1div", page or ""))
        whole.update((i, x) for x in H.main_text(page).split("\n") if x)
        alone.update((i, x) for x in H.main_text(plain).split("\n") if x)
    both = (whole & alone).total()
    assert both >= 0.8 * whole.total() and both >= 0.97 * alone.total()


def test_empty_table(spark):
    empty = spark.createDataFrame([], "page_id long, html string, text int")
    got = H.with_main_text(empty)
    assert got.columns == ["page_id", "html", "text"] and got.count() == 0
