"""The labelled table of operator 8: example pages made by rule from a few
invented sentences. Blocks of article text start with [[ ; every other block
is boilerplate. Most pages have neither telling elements nor names."""

_LONG = ("The river rose again in the night and by morning the lower road was closed, so the "
         "school bus went round by the mill and came an hour late to the village.")
_MID = "She had not expected an answer so soon, and read the letter twice."
_LINKED = f'{_LONG} See <a href="/m">the map</a> of it. {_MID}'

#: article blocks: lengths as they follow each other
_ARTICLES = [
    [("h1", "The river"), ("p", _LONG), ("p", _LONG), ("p", _LONG)],
    [("p", f"{_LONG} {_LONG}"), ("p", _LONG), ("p", _MID), ("p", f"{_LONG} {_LONG} {_LONG}")],
    [("h1", "A letter for the miller"), ("p", _MID), ("p", "Rain."), ("p", _LONG), ("p", _MID)],
    [("h2", "Ice"), ("p", _LINKED), ("p", "Nobody was hurt."), ("p", "Yes."), ("p", _LONG)],
    [("h1", "Market day by the mill"), ("p", _LONG), ("h2", "What came then"), ("p", _LONG),
     ("p", "It was late."), ("p", f"{_LONG} {_MID}")],
    [("p", _LONG), ("blockquote", "It never ran better, he said."), ("p", _LONG),
     ("li", "one wheel of oak"), ("li", "two stones from the quarry"), ("li", "a bell"), ("p", _MID)],
]
_LINKS = ["Home", "News", "Sport and games", "About us", "Contact"]


def _article(blocks, tag: str | None = None) -> str:
    return "".join(f"<{tag or t}>[[{x}</{tag or t}>" for t, x in blocks)


def _links(tag: str) -> str:
    return "".join(f'<{tag}><a href="/{w}">{w}</a></{tag}>' for w in _LINKS)


def _bare(blocks) -> list[str]:
    """Nothing says what is what."""
    one = "".join(f' <a href="/{w}">{w}</a> |' for w in _LINKS)
    return [
        f"<body>{_article(blocks)}</body>",
        f"<body><div id=x1>{_article(blocks)}</div></body>",
        f"<body><div>{one}</div>{_article(blocks)}<div>{one}</div></body>",
        f"<body><ul>{_links('li')}</ul><div>{_article(blocks, 'div')}</div><p>Read next: <a href='/n'>"
        f"the long winter of our fathers in the hills</a></p>{_links('p')}</body>",
        f"<body>{_links('div')}<div>Tuesday, page three</div>{_links('div')}<div>{_article(blocks)}"
        f"</div>{_links('p')}<div>Printed in the village</div>{_links('div')}</body>",
        f"<body><p>{one}</p><table><tr><td>{_article(blocks)}</td></tr></table><p>{one}</p>"
        "<p>All rights reserved</p></body>",
    ]


def _with_elements(blocks) -> list[str]:
    """Furniture elements, with and without an article element."""
    head = f"<header><h2>Village News</h2><p>Your paper since 1902, every day</p></header><nav>{_links('li')}</nav>"
    foot = f"<footer><p>Imprint</p><p>{_MID}</p><p>Village News, all rights reserved.</p></footer>"
    form = "<form><p>Send us your view here</p><label>Name</label></form>"
    return [
        f"<body>{head}{_article(blocks)}{foot}</body>",
        f"<body>{head}<article><header>{_article(blocks[:1])}</header>{_article(blocks[1:])}</article>{foot}</body>",
        f"<body>{head}<main>{_article(blocks)}<aside><p>Sign up for our letter: {_LONG}</p></aside>"
        f"{_article(blocks[:2])}</main>{form}{foot}</body>",
        f"<body><div role=navigation><p>Sections</p>{_links('p')}</div><article>{_article(blocks)}"
        f"<p>[[<a href='/q'>The whole report</a></p></article><div role=contentinfo><p>{_LONG}</p></div></body>",
        f"<body><dialog><p>{_LONG}</p><p>Close</p></dialog><article>{_article(blocks)}</article>{foot}</body>",
    ]


def _with_names(blocks) -> list[str]:
    """Names around furniture, names around articles that only sound so."""
    return [
        f"<body><div class=ad>{_MID}</div><article>{_article(blocks)}</article><footer>{_MID}</footer></body>",
        f"<body><div class=ad>Buy two pairs of boots today.</div>{_article(blocks)}"
        f"<div class=newsletter><p>{_LONG}</p></div></body>",
        f"<body><div class=cookie-notice><p>We use cookies. {_MID}</p></div><div class='content with-sidebar'>"
        f"{_article(blocks)}</div><div class=sidebar><h3>Most read</h3><p>{_LONG}</p></div>"
        f"<section id=comments><h3>3 comments</h3><p>{_LONG}</p><p>Nice.</p></section></body>",
        f"<body><article class='post category-social'>{_article(blocks[:2])}<div class=ad>{_MID}</div>"
        f"<section id=legal>{_article(blocks)}</section><div class=advert>Order now.</div>"
        f"<section class=reply>{_article(blocks)}</section><div class=promo><p>{_MID}</p></div>"
        f"<section class=comments><p>{_LONG}</p><p>{_MID}</p><p>Nice.</p></section></article></body>",
        f"<body><div class=popup><p>{_MID}</p></div><div class=entry>{_article(blocks)}</div>"
        f"<div class=user-comments><p>{_LONG}</p><p>{_MID}</p></div><div id=footer><p>{_LONG}</p></div></body>",
        f"<body><div class=site-sidebar><p>{_LONG}</p><p>{_LONG}</p><p>{_MID}</p></div><div class='post tags-list'>"
        f"{_article(blocks)}</div><div class=our-sharing><p>{_LONG}</p><p>{_MID}</p></div></body>",
        f"<body><main class=has-sidebar>{_article(blocks)}<div class=related><h4>Read next</h4>{_links('p')}"
        f"</div>{_article(blocks[-1:])}</main><div class=banner><p>{_LONG}</p><p>Only today!</p></div></body>",
    ]


PAGES = [page for blocks in _ARTICLES
         for page in (*_bare(blocks), *_with_elements(blocks), *_with_names(blocks))]
# plain text; an article whose tags are left open; a page that is nothing but furniture
PAGES += [f"[[{_LONG}", f"[[{_LONG} {_MID}", f"[[{_MID}", "Not found", "Please log in",
          f"<body><nav><a href=/>Home</a></nav><article><h1>[[Snow</h1><p><b>[[{_MID}<br><p>[[{_LONG}</p>"
          f"<p>[[Cold.</p><p><b>[[{_LONG}<br><p>[[Still cold.</p></article><footer>{_MID}</footer>",
          f"<body>{_links('li')}<p>Not found</p>{_links('p')}</body>"]
