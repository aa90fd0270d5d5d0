"""Hand-made pages in the manner of common sites, and the article that each holds."""

PROSE = (
    "The harbour town woke late that morning, and the boats stayed where they were. Nobody could say when the storm would end.",
    "By noon the council had met twice. Its members agreed on little, except that the old pier had to be closed.",
    "A short line.",
    "Engineers who looked at the pillars in spring had warned of rust. Their letter, three pages long, was never answered by anybody in the office.",
)

PAGES = [
    # A site of articles with a menu, comments and a sidebar.
    (
        f"""<!doctype html><html><head><title>Pier closed</title><script>if (a < b) document.write("<p>no</p>");</script></head>
        <body class="single has-sidebar"><header class="site-header"><a class="logo" href="/">Harbour Post</a><nav><ul><li><a href="/a">News</a><li><a href="/b">Sport</a></ul></nav></header>
        <main><article class="post"><h1>Old pier&nbsp;closed</h1><p>{PROSE[0]}</p><aside class="related"><h3>See also</h3><ul><li><a href="/x">Storm of the year</a></li></ul></aside>
        <p>{PROSE[1]}<p>{PROSE[2]}</p><div class="ad-slot">Buy boats now. The best boats in town are ours.</div><h2>What now?</h2><ul><li>Close it</li><li>Mend it</li></ul></article>
        <section id="comments"><h3>2 comments</h3><div class="comment"><p>I walked there as a child, and my father before me. What a shame it is.</p></div>
        <div class="comment"><p>About time.</p></div></section></main><aside class="sidebar"><p>Most read this week in our town and beyond it.</p></aside>
        <footer><p>&copy; 2021 Harbour Post. All rights reserved.</p></footer></body></html>""",
        ["Old pier closed", PROSE[0], PROSE[1], PROSE[2], "What now?", "Close it", "Mend it"],
    ),
    # Old markup: no telling elements, names in ids.
    (
        f"""<html><body><div id="wrapper"><div id="header"><h2>My log</h2></div><div id="nav"><a href=1>Home</a> | <a href=2>About</a></div>
        <div id="content"><h1>Notes &amp; news</h1><p>{PROSE[3]}</p><p>{PROSE[0]}</p><p>{PROSE[1]}</p></div>
        <div id="sidebar"><h3>Archive</h3><ul><li><a href=3>May</a></li><li><a href=4>June</a></li></ul></div>
        <div id="footer">Copyright by me | <a href=5>Imprint</a></div></div></body></html>""",
        ["Notes & news", PROSE[3], PROSE[0], PROSE[1]],
    ),
    # Notices, a form, and a page that breaks off.
    (
        f"""<div class="cookie-banner"><p>We use cookies to make this site better for you. By going on you accept them.</p><button>Accept all</button></div>
        <article><h1>Storm</h1><p>{PROSE[0]}</p><form class="newsletter"><label>Your mail</label><input><p>Sign up and never miss any of our stories again.</p><button>Sign up</button></form>
        <p>{PROSE[3]}</p></article><div class="comments"><ol><li class="comment"><p>{PROSE[1]}</p></li></ol></div><footer>Made with care""",
        ["Storm", PROSE[0], PROSE[3]],
    ),
    # Everything within one form; the article has tables, quotes and inline marks.
    (
        f"""<html><body><form id="form1" action="/"><div class="top-menu"><ul><li><a href=1>A</a></li><li><a href=2>B</a></li></ul></div>
        <div class="article-body"><h1>Figures</h1><p>{PROSE[3]}</p><blockquote><p>{PROSE[2]}</p></blockquote><table><tr><th>Year</th><td>1999</td></tr></table><p><b>In <i>sum</i>:</b>
        all is <!-- not --> well.</p></div><div class="share"><ul><li><a href=3>Tweet</a></li></ul></div><div class="footer">Imprint</div></form></body></html>""",
        ["Figures", PROSE[3], PROSE[2], "Year", "1999", "In sum: all is well."],
    ),
    # No article at all.
    ("<html><body><nav><ul><li><a href=1>Home</a></li><li><a href=2>Help</a></li></ul></nav><form class='login'><label>Name</label></form><footer>&copy; us</footer></body></html>", []),
    # Nothing but an article.
    (f"<h1>Alone</h1><p>{PROSE[0]}</p><p>{PROSE[1]}</p>", ["Alone", PROSE[0], PROSE[1]]),
    # Comments inside the article element, adverts and notices between its paragraphs.
    (
        f"""<body><div class="page"><div class="masthead">The Daily</div><article><header><h1>Inside</h1></header><p>{PROSE[0]}</p><div class="advertisement"><p>{PROSE[2]}</p><p>Only today.</p></div>
        <p>{PROSE[1]}</p><div class="notice">This story was first sent out in May.</div><p>{PROSE[3]}</p>
        <section class="user-comments"><article class="comment"><p>{PROSE[1]}</p></article><article class="comment"><p>I agree.</p></article></section></article>
        <aside><h4>Popular</h4><p>{PROSE[2]}</p></aside></div></body>""",
        ["Inside", PROSE[0], PROSE[1], PROSE[3]],
    ),
    # Names of parts without elements of their own meaning.
    (
        f"""<body><div class="navbar"><span><a href=1>One</a></span> <span><a href=2>Two</a></span></div><div class="promo"><p>{PROSE[1]}</p></div><div class="entry-content"><h2>Second rank</h2>
        {PROSE[0]}<br><br>{PROSE[1]}<p>{PROSE[2]}</p></div><div class="widget"><p>{PROSE[0]}</p></div><div id="disqus_thread"><p>{PROSE[3]}</p></div><div class="site-footer"><p>{PROSE[2]}</p></div></body>""",
        ["Second rank", f"{PROSE[0]} {PROSE[1]}", PROSE[2]],
    ),
]
