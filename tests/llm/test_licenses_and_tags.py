"""Licenses that differ in a version or a name, and tags that are hard to read."""

import time

import pytest

from tenurekit.llm import html_main, license_scan
from tenurekit.llm.license_scan import NOTICES, Notices


def labels(text):
    search = Notices()
    return sorted({search.notices[i][0] for _, _, i, _ in search.find(text.encode() + b" ")})


@pytest.mark.parametrize("text", [
    "gnu lesser general public license version 2 1", "mozilla public license version 1 1", "licensed under the apache license version 1 1",
    "released under the mpl license", "bsd 4 clause license", "licensed under the gnu general public license version 1", "licensed under cc by sa 3 0",
    "licensed under the gnu general public license version 2 1", "licensed under the gnu general public license version 20",
    "licensed under cc by 2 0", "released under the gpl license", "gnu library general public license version 3", "cc0 2 0 universal public domain dedication"])
def test_other_versions_and_names_are_not_labelled(text):
    assert labels(f"some words before {text} and after it") == []


@pytest.mark.parametrize("label,text", NOTICES)
def test_every_notice_is_found_exactly_and_with_an_edit(label, text):
    assert label in labels(f"before {text} after")
    assert label in labels(text)
    # an edit in the longest word that is not protected
    words = text.split(" ")
    free = [w for w in words if w not in license_scan.protected(words)]
    longest = max(free, key=len, default="")
    if license_scan.edits_allowed(text) and len(longest) > 5:
        edited = text.replace(longest, longest[:3] + "q" + longest[4:], 1)
        assert label in labels(f"before {edited} after")


def test_version_with_a_zero_or_a_later_number_stays():
    assert labels("licensed under the gnu general public license version 3 0 of 2007") == ["gpl-3"]
    assert labels("licensed under the gnu general public license version 2 1991 edition") == ["gpl-2"]


def test_scan_reports_no_label_for_the_other_version(spark):
    df = spark.createDataFrame([(1, "It is licensed under CC BY-SA 3.0 now"), (2, "It is licensed under CC BY-SA 4.0 now"), (3, None)], "doc_id long, text string")
    got = {r.doc_id: (r.labels, r.score) for r in license_scan.scan_licenses(df).collect()}
    assert got[1] == ("", 0.0) and got[2] == ("cc-by-sa", 1.0) and got[3] == ("", 0.0)


LONG = "This is the first paragraph of the article and it is long enough to be read as the text of the page by the rules."


def test_apostrophe_in_an_unquoted_value():
    page = f"<html><body><article><p title=it's>First paragraph isn't lost here. {LONG}</p><p>Second one.</p></article></body></html>"
    assert html_main.main_text(page) == f"First paragraph isn't lost here. {LONG}\nSecond one."


def test_quotes_and_equals_signs_in_tags():
    page = f"""<article><p data-x='a>b' title = "1 > 0" "odd' x==y>{LONG}</p><a href=/a?b=c'd>{LONG}</a></article>"""
    assert html_main.main_text(page) == f"{LONG}\n{LONG}" or html_main.main_text(page) == LONG + LONG
    assert html_main.blocks_of("<p a='unclosed>text</p><p>more") is not None


@pytest.mark.parametrize("attribute", ['data-id="comments"', 'data-class="sidebar"', 'title="class=menu"', "aria-role=navigation"])
def test_attributes_that_only_look_like_places(attribute):
    assert html_main.main_text(f"<article><div {attribute}><p>{LONG}</p></div></article>") == LONG


@pytest.mark.parametrize("attribute", ['class="sidebar"', "id=comments", "CLASS='x menu'", 'role="navigation"', "hidden", 'style="display: none"'])
def test_attributes_that_are_places(attribute):
    assert html_main.main_text(f"<article><p>{LONG}</p><div {attribute}><p>Other {LONG}</p></div></article>") == LONG


@pytest.mark.parametrize("hostile", ["<p " * 40_000 + '"', "<p a='" * 40_000, "<a title=\"" * 40_001, "<p = " * 40_000, "<!--" * 40_000, "<p a=" + " " * 200_000 + "x"])
def test_hostile_pages_take_linear_time(hostile):
    begin = time.perf_counter()
    html_main.main_text(hostile)
    assert time.perf_counter() - begin < 5


PROSE = "It is the first of the lines and it goes on for the sake of the test and of the reader, who is not in a hurry and has the time to read all of it. " * 2


def test_the_passes_decide(monkeypatch):
    links = "".join(f"<a href=/{i}>Keyword{i} Brand{i} Offer{i}</a> " for i in range(30))
    page = f"<div><div>{PROSE}</div><p>Short one.</p><div>{PROSE}</div><div>{links}</div></div>"
    want = f"{PROSE.strip()}\nShort one.\n{PROSE.strip()}"
    assert html_main.main_text(page) == want  # link density drops the last block, the short one inherits
    article = f"<article><h1>Title</h1><p>{PROSE}</p><p>Short.</p></article>"
    assert html_main.main_text(article) == f"Title\n{PROSE.strip()}\nShort."
    with monkeypatch.context() as m:
        m.setattr(html_main, "LINKS_MAX", 1.0)
        assert html_main.main_text(page) != want
    with monkeypatch.context() as m:
        m.setattr(html_main, "_STOP", frozenset())
        assert html_main.main_text(page.replace(links, "Nothing of worth " * 20)) != html_main.main_text(page)
    monkeypatch.setattr(html_main, "first_pass", lambda b: "bad")
    assert html_main.main_text(page) == "" and html_main.main_text(article) == ""
