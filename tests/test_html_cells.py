"""HTML extraction (job_extract) on hand-made pages: unclosed tags, comments, scripts."""

from skirmish.functions import html_cells as H

PAGE = """<html><head><title> Match  page </title><meta name="description" content="desc here">
<script>var x = "<a href='/nope'>";</script><style>.a{}</style></head>
<body><!-- <a href="/commented">x</a> -->
<div id="main" class="col mod-3"><h1>Team A <span>vs</span> Team B</h1>
<ul class="links"><li><a href="/1/a">one</a><li><a href="/2/b" class="x">two</a></ul>
<p>unclosed <b>bold</p><a>no href</a>
<div class="vm-stats-game" data-game-id="all"></div><div class="vm-stats-game" data-game-id="7"><div></div></div>
</div></body></html>"""


def test_fields():
    rows = H.extract(PAGE, [("title", "title", "text"), ("h1", "h1", "text"), ("h1own", "h1", "own"),
                            ("link", "a[href]", "attr:href"), ("desc", "meta[name=description]", "attr:content")])
    got = {}
    for f, pos, raw in rows:
        got.setdefault(f, []).append(raw)
    assert got["title"] == [" Match  page "]
    assert got["h1"] == ["Team A vs Team B"]
    assert got["h1own"] == ["Team A  Team B"]
    assert got["link"] == ["/1/a", "/2/b"]          # script body and comment are not elements
    assert got["desc"] == ["desc here"]


def test_selectors():
    root = H.parse(PAGE)
    assert [n.attrs["href"] for n in H.select(root, "ul.links > li a.x")] == ["/2/b"]
    assert [n.attrs["data-game-id"] for n in H.select(root, "div[data-game-id]")] == ["all", "7"]
    assert len(H.select(root, "#main h1 span")) == 1
    assert [n.tag for n in H.select(root, "ul > li:nth-child(2)")] == ["li"]
