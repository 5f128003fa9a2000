"""op2's text, title and language: equal to the patterns that define them, in linear time on hostile pages."""
import random
import re
import time

import pytest

from covlens.llm import warc

HIDDEN = re.compile(r"(?is)<!--.*?-->|<!\[CDATA\[.*?\]\]>|<(script|style|noscript|template|svg|head)\b[^>]*>.*?</\1\s*>"
                    r"|<(?:script|style)\b.*\Z")
TITLE = re.compile(r"(?is)<title\b[^>]*>(.*?)</title\s*>")
LANG = re.compile(r"""(?is)<html\b[^>]*\blang\s*=\s*["']?([A-Za-z-]+)""")
PIECES = ["<!--", "-->", "<![CDATA[", "]]>", "<script", "</script>", "<style>", "</STYLE >", "<svg", "</svg>", "<svgx>", "<head>", "</head",
          ">", "<p", "<p>", "</p>", "<b>", "<title", "<title>", "</title>", "<html", ' lang="en"', " lang=de", "xlang=fr", "lang=", " ", "a", "é", "\n", "<"]


def brute_text(html):
    return warc._TAG.sub("", warc._BREAK.sub("\n", HIDDEN.sub("\n", html)))


@pytest.mark.parametrize("seed", range(4))
def test_equal_to_the_patterns(seed):
    rng = random.Random(seed)
    for _ in range(5000):
        html = "".join(rng.choice(PIECES) for _ in range(rng.randrange(16)))
        got = warc._sub_tags(warc._TAG, "", warc._sub_tags(warc._BREAK, "\n", warc._visible(html)))
        assert got == brute_text(html), html
        title, lang = TITLE.search(html), LANG.search(html)
        assert warc._title(html) == (title[1] if title else None), html
        assert warc._language(html) == (lang[1].lower() if lang else None), html


@pytest.mark.parametrize("piece", ["<!--", "<svg>", "<svg ", "<p ", "<b ", "<![CDATA[", "<title>", "<title ", "<html ", "<html>", "<head><",
                                   "</svg ", "<svg></svg ", "<script ", "<html lang ", "&", "<!-- --"])
def test_a_megabyte_of_unclosed_marks_takes_seconds(piece):
    for tail in ("", ">", "-->"):
        page = piece * ((1 << 20) // len(piece)) + tail
        began = time.perf_counter()
        warc.derive(1, "http://a.example/", page, "2024-01-01T00:00:00Z")
        assert time.perf_counter() - began < 5, (piece, tail)
