"""Small labelled pages for the block classifier: ``data-y="1"`` marks what is main text, ``data-y="0"`` what is not."""

_LONG = "The council met on Monday to discuss the new bridge, and most members agreed that work should begin before the winter."
_MORE = "Residents had asked for a crossing since the old one was closed; the cost, they were told, will be shared by three towns."

LABELLED_PAGES = [
    f"<body><nav><ul><li><a href=a>Home</a></li><li><a href=b>News</a></li></ul></nav><article data-y=1><h1>Bridge approved</h1><p>{_LONG}</p>"
    f"<p>{_MORE}</p><p>So be it.</p></article><footer>&copy; 2020 The Paper. All rights reserved.</footer></body>",
    f"<body><div id=header class=masthead>The Daily Paper</div><div class='menu top'><a href=a>Sport</a> <a href=b>Weather</a></div><div id=content data-y=1>"
    f"<h2>A new start</h2><div>{_LONG}</div><div>{_MORE}</div><ul><li>First point of the plan.</li><li>Second point of the plan.</li></ul></div>"
    "<div class=sidebar><h3>Most read</h3><p>Ten ways to save money this year</p><p>What to do on Sunday</p></div><div class='ad banner'>Buy our shoes now, only today.</div></body>",
    f"<body><header><p>Welcome to our pages</p></header><main><h1 data-y=1>Report</h1><p data-y=1>{_MORE}</p><blockquote data-y=1>We did what we could.</blockquote>"
    f"<p data-y=1>{_LONG}</p><section class=comments><h3>Comments</h3><div class=comment><p>I do not agree with this at all, the bridge is too dear.</p></div>"
    "<div class=comment><p>Great piece, thanks for writing.</p></div></section></main><aside><p>Subscribe to our letter and read more stories like this.</p></aside></body>",
    f"<body><div class='cookie-notice'>We use cookies to make this site better. By going on you agree to them.</div><div class=post data-y=1><p>{_LONG}</p><pre>a = b + c</pre>"
    f"<table><tr><td>Year</td><td>Cost</td></tr><tr><td>2019</td><td>12</td></tr></table><p>{_MORE} <a href=x>See the report</a>.</p></div>"
    "<div class='share social'><a href=a>Tweet</a> <a href=b>Mail</a></div><div class=related><a href=q>Also read: the old bridge falls</a></div></body>",
    f"<body><form action=x><label>Name</label><p>Enter your address to get our letter every week.</p></form><div class='entry-content' data-y=1><p>{_MORE}</p><h3>Cost</h3>"
    f"<p>Nobody knows.</p><p>{_LONG}</p></div><div class=advert><p>Sponsored: the best mattresses of the year, tested by our experts.</p></div><div id=footer><p>About us | Contact | Terms</p></div></body>",
    f"<body><p data-y=1>{_LONG}</p><p data-y=1>{_MORE}</p></body>", "<body data-y=1>A short page with plain text and nothing else in it.</body>",
    f"<body><div class=popup>Sign up now and save half.</div><article data-y=1><h1>Of cats</h1><p>Yes.</p><p>{_LONG}</p><p>###$$$ %%% &&& ***</p></article>"
    "<div class=ad>En la calle hay una casa de flores. Compre hoy.</div><footer>example.org &middot; Todos los derechos reservados por la casa.</footer></body>",
    f"<body><div class=ad>{_MORE}</div><article data-y=1><p>Short.</p><p>{_LONG}</p></article><footer>{_LONG}</footer></body>",
    f"<body><div class=breadcrumbs><a href=a>Home</a> / <a href=b>Town</a></div><div class=article-body data-y=1><p>{_LONG}</p><p>{_MORE}</p></div>"
    f"<div id=comments><p>{_MORE}</p><p>{_LONG}</p></div><div class=notice><p>This site needs a newer browser.</p></div></body>",
]
