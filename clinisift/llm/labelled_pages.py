"""Small pages whose text blocks are labelled: "+" begins a block of main text, "-" any other block."""

_LONG = "the committee met again on tuesday to go through the figures that the office had sent and found that most of them had changed since the spring"
_MORE = "people who live near the river said that the water had risen twice this year and that nobody had told them about the plans for the new wall"
_PART = "a second report is expected before the end of the month"
_SHORT = "that was all"

LABELLED_PAGES: tuple[str, ...] = (
    # A page with an article element, a menu of links, an advert and a footer.
    f"""<html><head><title>-news</title></head><body><nav><ul><li><a href=1>-home</a></li><li><a href=2>-world</a></li><li><a href=3>-sport today</a></li></ul></nav>
    <div class="ad">-buy two and get the third one for nothing at all</div><article><h1>+river rises again</h1><p>+{_LONG}</p><p>+{_SHORT}</p><p>+{_MORE}</p><p>+no.</p>
    <p>+{_PART}</p></article><footer>-&copy; the daily news, all rights reserved by the owners of the site</footer></body></html>""",
    # The same with a sidebar, a consent notice, a form and comments after the article.
    f"""<body><header><a href=1>-the news</a><p>-fresh stories from all over the country every morning at six</p></header><div id="cookie-notice"><p>-we use cookies to
    make this site work better for you and to measure how it is used by our readers and partners</p><button>-ok</button></div><main><article><h1>+title of it</h1>
    <p>+{_MORE}</p><h2>+what next</h2><p>+{_PART}</p><ul><li>+first point of three</li><li>+second point</li><li>+third <a href=9>point</a></li></ul><p>+{_LONG}
    <a href=4>source</a></p></article></main><aside class="sidebar"><h3>-most read</h3><ul><li><a href=5>-a man walks his dog</a></li><li><a href=6>-the dog walks back</a></li>
    </ul><p>-{_LONG}</p></aside><form><label>-your mail</label></form><section class="comments"><h3>-two comments</h3><p>-i was there and i can say that it was not like this at
    all and the people who wrote it should be ashamed</p><p>-good piece</p></section><footer><p>-imprint and contact</p><p>-{_PART}</p></footer></body>""",
    # Classes on plain elements.
    f"""<body><div class="topbar"><a href=1>-log in</a> <a href=2>-join</a></div><div class="header"><p>-all you need to know about gardens and the plants in them</p></div>
    <div class="post-content"><h1>+how to plant a tree</h1><p>+{_LONG}</p><p>+water it.</p><p>+{_MORE}</p><p>+{_PART}</p></div><div class="related"><p>-how to cut a hedge in
    the summer without harming the birds that nest in it</p><p><a href=3>-more</a></p></div><div class="share"><a href=4>-send</a></div><div id="comments"><p>-{_MORE}</p>
    <p>-thanks a lot</p></div><div class="footer"><p>-written by the garden team of the town, with help from its friends</p></div></body>""",
    # Notices and forms inside the article.
    f"""<body><div class="menu"><a href=1>-start</a></div><article><header><h1>+one long day</h1></header><p>+{_MORE}</p><div class="newsletter"><p>-get our letter every week and
    read the best stories before all others do</p></div><p>+{_LONG}</p><div class="advert"><p>-new shoes for old feet, now in all our shops</p></div><p>+yes.</p><p>+{_PART}</p>
    <footer><p>-the author lives in a small town and writes about its people</p></footer></article><div class="widget"><p>-weather for today and the next few days in your town</p></div></body>""",
    # No names at all: long text with few links is the main text, lists of links and short lines at the ends are not.
    f"""<body><div><a href=1>-home</a></div><div><a href=2>-about us</a></div><div><a href=3>-contact</a></div><div>+{_LONG} {_MORE}</div><div>+{_MORE} {_PART}</div><div>+{_LONG}</div>
    <div><a href=4>-next page</a></div><div><a href=5>-terms</a></div><div>-all rights reserved</div></body>""",
    f"""<body><table><tr><td><a href=1>-one</a></td><td><a href=2>-two</a></td></tr></table><p>+{_MORE} {_LONG}</p><p>+{_LONG} {_PART}</p><p>+{_MORE}</p>
    <p><a href=3>-back to the list of all pages of this site</a></p><p>-last changed in may</p></body>""",
    f"""<body><p><a href=1>-a</a> <a href=2>b</a> <a href=3>c</a></p><h1>+on rivers</h1><p>+{_LONG}</p><p>+{_MORE} {_PART}</p><p>+{_LONG} {_MORE}</p><p><a href=4>-up</a></p></body>""",
    # A page with nothing but frames.
    f"""<body><nav><a href=1>-home</a></nav><div class="banner"><p>-{_LONG}</p></div><form><p>-{_PART}</p></form><footer><p>-{_MORE}</p></footer></body>""",
    # An article and nothing else, its last block the last of the page; a paragraph that is one link.
    f"""<article><h1>+a page of its own</h1><p>+{_LONG}</p><p>+<a href=1>the whole report</a></p><p>+so it ends.</p></article>""",
    f"""<body><article><p>+{_MORE}</p><p>+<a href=1>first</a> <a href=2>second</a></p><p>+{_SHORT}</p><p>+<a href=3>sources</a></p></article></body>""",
    f"""<main><p>+{_PART}</p><p>+<a href=1>photo</a></p><p>+{_SHORT}</p></main>""",
    # Plain blocks around an article.
    f"""<body><div>-{_PART}</div><div>-the paper for the whole family since the year the bridge was built</div><article><h1>+bridge closed</h1><p>+{_LONG}</p><p>+{_SHORT}</p></article>
    <div>-{_MORE}</div><div>-{_LONG}</div></body>""",
    f"""<body><p>-{_LONG}</p><div class="entry"><p>+{_MORE}</p><p>+fine.</p></div><p>-{_MORE}</p><p>-end of page</p></body>""",
    # One or few paragraphs without any names.
    f"""<p>+{_LONG} {_MORE}</p>""",
    f"""<h1>+a letter</h1><p>+{_MORE}</p><p>+{_LONG}</p>""",
    f"""<body><p><a href=1>-home</a></p><p>+{_LONG}</p><p>+{_PART}</p><p>+{_MORE}</p></body>""",
    # A form around the whole page, with and without an article in it.
    f"""<body><form id="aspnetForm"><div class="menu"><a href=1>-start</a></div><article><h1>+a road through the wood</h1><p>+{_LONG}</p><p>+{_SHORT}</p><p>+{_MORE}</p></article>
    <div class="search-box"><p>-{_PART}</p></div><div class="footer"><p>-imprint and contact of the paper</p></div></form></body>""",
    f"""<body><form><p><a href=1>-home</a></p><p>+{_LONG}</p><p>+{_MORE} {_PART}</p><p>+{_LONG} {_MORE}</p><p><a href=2>-up</a></p></form></body>""",
    # A layout named after its sidebar, around the article, the sidebar and comments that are articles themselves.
    f"""<body><nav><a href=1>-home</a></nav><div class="layout has-sidebar"><article><h1>+the old mill</h1><p>+{_MORE}</p><p>+{_PART}</p><p>+{_LONG}</p></article>
    <div class="sidebar"><p>-{_MORE}</p></div><section class="comments"><article><p>-{_LONG}</p></article><article><p>-well said</p></article></section></div></body>""",
    f"""<body><div id="page" class="with-sidebar"><main><h1>+bread</h1><p>+{_LONG}</p><p>+{_SHORT}</p></main><div class="widget"><p>-{_PART}</p></div></div>
    <footer><p>-{_LONG}</p></footer></body>""",
)
