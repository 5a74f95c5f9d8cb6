from twintally.llm.html_density import extract, main_text

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
<header><a href=/>Home</a></header><nav><ul><li><a href=a>Menu one</a><li><a href=b>Menu two</a></ul></nav>
<div class="cookie-notice"><p>We use cookies &amp; more, accept them please all of you.</p></div>
<div id=content><article><h1>The   title</h1><p><b>First &lt;paragraph&gt;
 with a <a href=x>link</a> in it.<br><p>Second&nbsp;one, unclosed<ul><li>point one<li>point two</ul>
<div class="related"><a href=1>Other story</a></div></article></div>
<aside><p>Sidebar text that is rather long, longer than any paragraph of the article itself, on purpose.</p></aside>
<section id="comments"><p>A reader says something long, something much longer than the article has to say.</p></section>
<form><input name=q><p>Search this</p></form><footer>&copy; us</footer></body></html>"""


def test_article_only():
    assert extract(PAGE) == "The title\nFirst <paragraph> with a link in it.\nSecond one, unclosed\npoint one\npoint two"


def test_truncated_stray_and_plain():
    assert extract(PAGE[:PAGE.index("Second")]) == "The title\nFirst <paragraph> with a link in it."
    assert extract("just text &eacute; here") == "just text é here"
    assert extract("<p>a</i>b</p></div>c") == "ab\nc"
    assert extract("<div><p>x") == "x"
    assert [extract(x) for x in (None, "", "<script>x", "<!-- c", "<br><br>")] == [""] * 5
    assert extract("<table><tr><td>a<td>b<tr><td>c</table>") == "a\nb\nc"


def test_density_chooses_the_text_without_any_hints():
    menu = "".join(f"<div><a href={i}>entry {i}</a></div>" for i in range(30))
    body = "".join(f"<p>{'words of the article go on ' * 8}{i}</p>" for i in range(6))
    got = extract(f"<body><div>{menu}</div><div>{body}</div><div>{menu}</div></body>")
    assert got.count("\n") == 5 and "entry" not in got


def words(n, name):
    return (f"{name} words of this part go on and on " * 20)[:n].strip()


A, B = [words(500, f"A{i}") for i in range(5)], [words(60, f"B{i}") for i in range(5)]
C = [words(30, f"C{i}") for i in range(10)]
SECTIONS = (f"<section>{''.join(f'<p>{x}</p>' for x in A)}</section><section>{''.join(f'<p>{x}</p>' for x in B)}</section>"
            f"<section><ul>{''.join(f'<li>{x}</li>' for x in C)}</ul></section>")


def test_every_section_of_an_article():
    want = "\n".join(["Title", *A, *B, *C])
    menu = "<div><a href=1>one entry</a><a href=2>two entries</a></div>"
    assert extract(f"<body><nav>x</nav><article><h1>Title</h1>{SECTIONS}</article>{menu}</body>") == want
    assert extract(f"<body>{menu}<main><h1>Title</h1>{SECTIONS}</main></body>") == want
    assert extract(f"<body>{menu}<div><div>Logo</div><div><h1>Title</h1>{SECTIONS}</div><div>Tail</div></div></body>") == want
    assert extract(f"<body><h1>Title</h1>{SECTIONS}{menu}</body>") == want


def test_a_long_block_beside_short_paragraphs():
    short = "".join(f"<p>{x}</p>" for x in B)
    for tag in ("blockquote", "div", "section"):
        got = extract(f"<body><div>{short}<{tag}>{''.join(f'<p>{x}</p>' for x in A)}</{tag}><p>the end</p></div></body>")
        assert got == "\n".join([*B, *A, "the end"])


def test_class_words_are_one_factor():
    body, text = "".join(f"<p>{x}</p>" for x in A), "\n".join(A)
    for name in ("content has-sidebar", "post no-comments", "entry with-related", "layout-menu-left", "page-widget"):
        page = f"<body><header><h1>T</h1></header><div class=menu><a href=1>m</a></div><div class='{name}'>{body}</div></body>"
        assert extract(page) == text, name
        assert extract(f"<body><article><h1>T</h1><div class='{name}'>{body}</div></article></body>") == "T\n" + text, name
    two = "".join(f"<div class=widget><p>{x}</p></div>" for x in A)
    assert extract(f"<body>{two}<div class=ad>Buy</div></body>") == text
    ad = f"<div class=sponsored>{body}{body}</div>"
    assert extract(f"<body>{ad}<article><h1>T</h1><p>{B[0]}</p></article></body>") == f"T\n{B[0]}"
    assert extract(f"<body><article><p>{B[0]}</p><div id=comments>{body}</div></article></body>") == B[0]


def test_parts_within_an_article():
    refs = "".join(f"<li><a href={k}>{x}</a></li>" for k, x in enumerate(C))
    inner = f"<p>{A[0]} <math><mi>x</mi></math></p><object><p>{A[1]}</p></object><label>{B[0]}</label><ol>{refs}</ol>"
    assert extract(f"<article>{inner}</article>") == "\n".join([A[0] + " x", A[1], B[0], *C])
    for start in ("<svg><path d=1>", "<select><option>one", "<object data=x>"):
        assert extract(f"<article><p>{A[0]}</p>{start}<p>{A[1]}</p><p>{A[2]}</p></article>") == "\n".join(A[:3]), start


def test_deep_and_long_pages():
    deep = "<div>" * 5000 + "<p>bottom text</p>"
    assert extract(deep) == "bottom text"
    assert len(extract("<p>" + "word " * 200_000)) == 999_999


def test_frame(spark):
    rows = [(1, "u", PAGE, "x"), (2, None, None, "x"), (2, None, None, "x"), (None, "v", "<p>t", "x")]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = [(r.page_id, r.url, r.text, r.n_chars) for r in main_text(frame).collect()]
    assert sorted(got, key=str) == sorted([(1, "u", extract(PAGE), len(extract(PAGE))), (2, None, "", 0), (2, None, "", 0),
                                           (None, "v", "t", 1)], key=str)
    assert main_text(frame.limit(0)).count() == 0


def test_time_grows_with_the_page_not_with_its_nesting():
    import time

    from twintally.llm.html_density import extract

    page = lambda n: "<html><body><article><h1>Title</h1><p>" + "word " * 50 + "</p></article>" + "<div class=ad><p>x</p>" * n + "</body></html>"
    begin = time.process_time()
    assert extract(page(12_000)).startswith("Title")
    assert time.process_time() - begin < 15          # 12,000 levels took minutes when each looked through all below it
