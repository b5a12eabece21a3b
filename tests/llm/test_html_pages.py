"""Pages whose elements end late, never or deep down keep their whole article."""

import time

import pytest

from creditloom.llm import html_extraction

PARTS = [
    "The rain that fell in the north will reach the coast by the end of the week.",
    "Farmers say that they have waited for it since spring and hope for more.",
    "Take a coat if you go out today, it is cold.",
]
MODEL = html_extraction.Model()


def _page(between="", head="<head><title>Trees</title></head>"):
    first, *rest = (f"<p>{p}</p>" for p in PARTS)
    return f"<html>{head}<body><nav><a>Home</a></nav><article><h1>On trees</h1>{first}{between}{''.join(rest)}</article><footer>All rights reserved</footer></body></html>"


@pytest.mark.parametrize("left_open", ["<datalist><option value=a>", "<button>Go", "<svg><path>", "<canvas>", "<object>", "<select><option>One", "<audio>"])
def test_an_element_without_end_does_not_take_the_article_along(left_open):
    assert html_extraction.main_text(_page(left_open), MODEL) == "\n\n".join(["On trees", *PARTS])


@pytest.mark.parametrize(
    "closed",
    [
        "<datalist><option value=a>A<option value=b>B</datalist>",
        "<select><option>One<option>Two</select>",
        "<select><option><div>One<option>Two</select>",
        "<button><div>Buy it now</div></button>",
        "<canvas><p>This text is for those who see no pictures, and it is long.</p></canvas>",
        "<noscript><p>Please enable scripts to read this page in all its beauty.</p></noscript>",
        "<textarea></p></article><p>what a reader wrote</textarea>",
        "<svg><title>Icon</title><text>drawn</text></svg>",
        "<script>var x = '</p></article>';</script>",
    ],
)
def test_an_element_with_its_end_is_left_out_whole(closed):
    assert html_extraction.main_text(_page(closed), MODEL) == "\n\n".join(["On trees", *PARTS])


def test_a_button_inside_a_sentence_does_not_cut_it():
    page = _page().replace("reach the coast", "reach <button>Map</button>the <svg><text>x</text></svg>coast")
    assert html_extraction.main_text(page, MODEL) == "\n\n".join(["On trees", *PARTS])


def test_a_head_without_end_tag_ends_at_the_body():
    assert html_extraction.main_text(_page(head="<head><title>Trees</title>"), MODEL) == "\n\n".join(["On trees", *PARTS])


@pytest.mark.parametrize("piece", ["<div>", "<button>a<p>b</p>", "<svg>", "</svg></div>", "<li>", "<div></p>"])
def test_deep_and_broken_pages_take_linear_time(piece):
    times = []
    for n in (4000, 32000):
        start = time.process_time()
        html_extraction.Tree.of("<article>" + piece * n)
        times.append(time.process_time() - start)
    assert times[1] < 24 * max(times[0], 0.05)


def test_long_pages_are_kept_whole():
    many = "".join(f"<p>{PARTS[i % 3]} This is paragraph {i}.</p>" for i in range(20_000))
    found = html_extraction.main_text(f"<html><body><article>{many}</article></body></html>", MODEL)
    assert found.count("\n\n") == 19_999
