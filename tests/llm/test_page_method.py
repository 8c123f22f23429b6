"""Pages that mark their article are paired and aligned like all others."""

from quern.llm import pages


def test_site_lines_in_a_marked_article(spark):
    page = lambda inside, outside: f"<body><div>{outside}</div><article>{inside}</article></body>"
    own = [f"<p>Story {i} begins.</p><p>Story {i} goes on.</p><p>A passage that stories share.</p>" for i in range(3)]
    rows = [(i, f"https://h.example/a/{i}", page(x + ("<p>All offers of the site</p>" if i == 1 else ""), "<p>All offers of the site</p>"))
            for i, x in enumerate(own)]
    found = {r.page_id: r.text for r in pages.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert found == {i: f"Story {i} begins. Story {i} goes on. A passage that stories share." for i in range(3)}
