"""Labelled pages from which weights are learned: fixed values, invented for this purpose.

Attribute `x` tells whether the words below an element belong to the main text (1) or not (0);
what is not below such an element does not. Pages stand for usual ways to build them.
"""

_WORDS = "word " * 12

PAGES = (
    # Elements that name their role; an advert and a share bar within the article.
    f"""<body><header><a href="/">{_WORDS}</a><h1>site</h1></header>
<nav><ul><li><a href="/a">word</a></li><li><a href="/b">word</a></li></ul></nav>
<main><article x=1><header><h1>word word word</h1><p>word word</p></header><p>{_WORDS * 4}</p>
<div class="ad" x=0>{_WORDS}</div><p>{_WORDS * 5}</p><h2>word word</h2><p>{_WORDS * 3}</p>
<ul><li>{_WORDS}</li><li>{_WORDS}</li></ul><blockquote>{_WORDS}</blockquote>
<div class="share social buttons" x=0><a href="#">word</a></div>
<footer x=0><p>{_WORDS}</p></footer></article></main>
<aside><h2>word</h2><p>{_WORDS}</p></aside>
<section class="comments" id="comments"><h2>word</h2><article class="comment"><p>{_WORDS}</p></article>
<form><label>word</label><button>word</button></form></section><footer><p>{_WORDS}</p></footer></body>""",
    # Divisions with classes.
    f"""<body><div id="header" class="header masthead"><div class="logo">word</div></div>
<div id="menu" class="menu navigation navbar"><ul><li><a href="/a">word word</a></li></ul></div>
<div class="notice cookie banner alert">{_WORDS}</div><div id="wrapper" class="container">
<div id="content" class="content post entry" x=1><h1 class="title headline">word word</h1>
<p>{_WORDS * 4}</p><div class="advert advertisement sponsored promo" x=0><p>{_WORDS}</p></div>
<p>{_WORDS * 4}</p><h3>word</h3><p>{_WORDS * 3}</p><pre>{_WORDS}</pre></div>
<div id="sidebar" class="sidebar widget"><h3>word</h3><ul><li><a href="/a">word word</a></li></ul></div>
<div class="related recommended"><h3>word</h3><a href="/b">{_WORDS}</a></div>
<div id="comments" class="comments discussion"><div class="comment reply"><p>{_WORDS}</p></div></div></div>
<div id="footer" class="footer copyright"><p>{_WORDS}</p></div></body>""",
    # Names in other words.
    f"""<body><div class="topbar breadcrumb"><a href="/">word</a></div><div role="navigation"><a href="/a">word</a></div>
<div class="gdpr consent popup modal" role="dialog"><p>{_WORDS}</p><button>word</button></div>
<div role="main" class="article body story text" x=1><h1>word word</h1><p>{_WORDS * 4}</p>
<figure><figcaption>{_WORDS}</figcaption></figure><p>{_WORDS * 4}</p><ol><li>{_WORDS}</li></ol>
<aside class="pullout" x=0><p>{_WORDS}</p></aside><p>{_WORDS * 2}</p></div>
<div class="newsletter signup subscribe"><form><p>{_WORDS}</p><input></form></div>
<div class="pagination pager"><a href="/2">word</a></div><div class="tags meta byline"><a href="/t">word</a></div>
<div class="respond replies feedback"><p>{_WORDS}</p></div><div class="disclaimer legal"><p>{_WORDS}</p></div>
<div role="contentinfo"><p>word</p></div><div role="complementary"><p>{_WORDS}</p></div></body>""",
    # Nothing named: plain paragraphs, and lists of links around them.
    f"""<body><table><tr><td><a href="/a">word word</a></td><td><a href="/b">word word</a></td></tr></table>
<div x=1><h1>word word</h1><p>{_WORDS * 4}</p><p>{_WORDS * 4}</p><h2>word</h2><p>{_WORDS * 4}</p>
<table><tr><td>{_WORDS}</td></tr></table><p>{_WORDS * 4}</p></div>
<div><ul><li><a href="/c">word word</a></li><li><a href="/d">word word</a></li></ul></div></body>""",
    # A section as the main text; a warning, adverts and a form beside it.
    f"""<body><div class="ads banner"><a href="/x">{_WORDS}</a></div><div class="warning message notification">{_WORDS}</div>
<section class="main content" x=1><h1>word</h1><p>{_WORDS * 5}</p><dl><dt>word</dt><dd>{_WORDS}</dd></dl>
<div><p>{_WORDS * 4}</p></div><p>{_WORDS * 3}</p></section><form class="search"><label>word</label></form>
<div class="comment list"><ol><li class="comment"><p>{_WORDS}</p></li></ol></div>
<div class="ad" id="ad"><p>{_WORDS}</p></div><footer class="site"><ul><li><a href="/a">word</a></li></ul></footer></body>""",
)
