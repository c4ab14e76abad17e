"""Structure that the stored pages lack, derived from the given tables by rule: links between
stored pages, image markup, junk paragraphs and blocked words in URLs.  Each rule is one SQL text
that Spark and DuckDB evaluate alike, so a query and its oracle read the same derived pages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.snapshots import load_table

# A listing of the two following pages in front of each page, and the third as its next listing.
# Links are single-quoted after a quoted ``>``, empty, bare after other attributes, and double-quoted.
_LINKS = """concat(CASE WHEN u1 IS NULL THEN '' ELSE concat('<ul class="listing"><li><a title="a > b" href=''', u1, '''>story one</a></li><li><a href="">',
          'no story</a></li><li><b>x</b><a class=z HREF = ', coalesce(u2, '/missing'), '>story two</a></li></ul>') END,
          CASE WHEN u3 IS NULL THEN '' ELSE concat('<a class="pagination__next" href="', u3, '">next</a>') END, html)"""
LINKED_PAGES_SQL = f"""SELECT page_id, url, {_LINKS} AS html FROM (
  SELECT p.page_id, p.url, p.html, a.url AS u1, b.url AS u2, c.url AS u3 FROM pages p
  LEFT JOIN pages a ON a.page_id = p.page_id + 1 LEFT JOIN pages b ON b.page_id = p.page_id + 2
  LEFT JOIN pages c ON c.page_id = p.page_id + 3)"""

# Images by page number: in a hero container, in content, inside advert and header containers,
# with and without srcset, blocked, lazy; one page in eight has none.
IMAGES = """concat(CASE page_id % 8
  WHEN 0 THEN ''
  WHEN 1 THEN concat('<div class="article-hero"><img src="/img/h', page_id, '.jpg"></div>')
  WHEN 2 THEN concat('<div class="article-hero"><img srcset="/a', page_id, '.jpg 320w, /b.jpg ', page_id % 5 * 200, 'w, /c.jpg 400w"></div>')
  WHEN 3 THEN concat('<div class="featured-image"><img src="/logo', page_id, '.png"></div>')
  WHEN 4 THEN concat('<div id="subscription-replace-entire-article"><div class="ad"><img src="/x.jpg"></div><p>t</p><img src="https://cdn.example/y', page_id, '.jpg"></div>')
  WHEN 5 THEN concat('<div id="subscription-replace-entire-article"><div class="header"><img src="z', page_id, '.jpg"></div></div>')
  WHEN 6 THEN concat('<div class="article-hero"><img srcset="/plain.jpg" src="/s', page_id, '.jpg"></div>')
  ELSE concat('<div class="featured-image"><img src="/banner.jpg"></div><div id="subscription-replace-entire-article"><img src="/w', page_id, '.jpg"></div>')
  END, html)"""

# Content images for the coverage samples: four, one without src, or none.
SAMPLES = """concat(CASE page_id % 3
  WHEN 0 THEN ''
  WHEN 1 THEN concat('<div class="article-body"><img src="/one', page_id, '.jpg" alt="short"><img src="/two.jpg"><img alt="an alternative text of more than thirty characters" srcset="/x 1w"><img src="/four.jpg"></div>')
  ELSE concat('<div class="mar-article-image"><p>t<img></div><img src="/outside.jpg">')
  END, html)"""

# Links in other forms than double quotes, in front of each page's own.
LINK_FORMS = """concat('<p><a class=x href=''/single', page_id, '''>single</a> <a href=/bare', page_id, '>bare</a> <A title="a > b" HREF = "/upper">UP</A> ',
  '<a data-href="/none">none</a> <a data-href="/no" href=''?q=1''>query</a></p>', html)"""

JUNK = """concat(html, CASE page_id % 5
  WHEN 0 THEN '<p>Subscribe to our newsletter and accept a cookie before you read on</p>'
  WHEN 1 THEN '<p>terms and conditions apply to what follows, click here to see them all</p>'
  WHEN 2 THEN '<p>We''re now on your phone: join whatsapp with the link bit.ly/abc today</p>'
  WHEN 3 THEN '<p>a {x} brace pair in an otherwise plain paragraph of some more text</p>'
  ELSE '' END)"""

# Pages of the models site: each is a listing of the three that follow it by number, and the detail page of its own model.  Titles may be
# blank, images in meta or gallery (with data-src), descriptions in an element or in meta, dates in two forms or missing.
MODEL_URL = "concat('https://makerworld.com/en/models/', page_id)"
MODEL_HTML = """concat('<html><head>',
  CASE page_id % 4 WHEN 0 THEN concat('<meta property="og:image" content="//img.example/m', page_id, '.jpg">') ELSE '' END,
  CASE page_id % 3 WHEN 1 THEN concat('<meta name="description" content="meta text ', page_id, '">') ELSE '' END,
  '</head><body><h3><a href="/en/models/', page_id + 1, '">Model ', page_id + 1, '</a></h3><h2><a href="/en/models/0"> </a></h2>',
  '<h2 class=t><a href=//makerworld.com/en/models/', page_id + 2, '>Model <b>', page_id + 2, '</b></a></h2>',
  '<h3>none</h3><h3><a href=''https://makerworld.com/en/models/', page_id + 3, '''>Model ', page_id + 3, '</a></h3>',
  CASE page_id % 4 WHEN 1 THEN concat('<div class="model-media"><img src="/i/', page_id, '.png"></div>')
                   WHEN 2 THEN concat('<div class="gallery"><img src="" data-src="/i/', page_id, '.png"><img src="/later.png"></div>') ELSE '' END,
  CASE page_id % 3 WHEN 0 THEN concat('<div class="model-description"><p>text of ', page_id, '</p><div>more</div></div>') ELSE '' END,
  CASE page_id % 5 WHEN 0 THEN '' ELSE concat('<span class="author-name">by <a> author ', page_id % 7, ' </a></span>') END,
  '<div class="tag-list"><a>tag', page_id % 3, '</a><a> </a><a>all</a></div>',
  CASE page_id % 3 WHEN 0 THEN '<time datetime="2024-01-05T00:00:00Z">x</time>' WHEN 1 THEN '<span class="publish-date">2024-01-06</span>' ELSE '' END,
  '</body></html>')"""

# Live articles, main containers, tags and times by page number, in front of each page; one page in six stays as it is.
ARTICLE_PARTS = """concat(CASE page_id % 6
  WHEN 0 THEN concat('<div id="liveArticleContent"><p>live text number ', page_id, ' with some words more to pass the limit</p><div id="live-article-content__livefeed-summary">',
    '<p class="article-first-paragraph">Lead number ', page_id, ' of the live article</p><p>summary words that go on for a while number ', page_id, '</p></div></div>')
  WHEN 1 THEN concat('<div id="liveArticleContent"><p>short live ', page_id, '</p></div>')
  WHEN 2 THEN concat('<div id="subscription-replace-entire-article"><p title="a > b" class="x article-first-paragraph">The lead of main article ', page_id, ' stands here</p>',
    '<p>main words that go on for a while and then for a while more, number ', page_id, '</p></div>')
  WHEN 3 THEN concat('<div id="article"><div class="mar-article"><div><div class="mar-article__article-tags"><div class="article-tags">Tag ', page_id % 4, '</div>',
    '<div class="article-tags"> </div><div class="article-tags">Local</div></div></div></div></div><div class="article-tags">outside</div>')
  WHEN 4 THEN concat('<time datetime="2024-01-', CASE WHEN page_id % 4 = 0 THEN '04' ELSE '15' END, 'T10:00:00Z">t</time>')
  ELSE '' END, html)"""

# Lines of scripts outside of any tag, a blank one and a zero, after each page.
SCRIPT_LINES = """concat(html, CASE page_id % 3
  WHEN 0 THEN concat(chr(10), 'var layer = 1;', chr(10), ' kept line ', page_id, chr(10), 'x.addEventListener(1)')
  WHEN 1 THEN concat(chr(10), '0', chr(10), '  ', chr(10), 'Window.ONLOAD()') ELSE '' END)"""

BLOCKED_URL = "concat(url, CASE page_id % 5 WHEN 0 THEN '?from=Advertisement' WHEN 1 THEN '?img=LOGO' ELSE '' END)"


def linked_pages(spark, sf) -> DataFrame:
    """Stored pages with links to the pages that follow them by number."""
    pages = load_table(spark, sf, "pages", ["page_id", "url", "html"])
    out = pages
    for i in (1, 2, 3):
        nxt = load_table(spark, sf, "pages", ["page_id", "url"])
        out = out.join(nxt.select((F.col("page_id") - i).alias("page_id"), F.col("url").alias(f"u{i}")), "page_id", "left")
    return out.select("page_id", "url", F.expr(_LINKS).alias("html"))


def pages_with(spark, sf, column: str, rule: str) -> DataFrame:
    """Stored pages with one column replaced by a rule above."""
    return load_table(spark, sf, "pages", ["page_id", "url", "html"]).withColumn(column, F.expr(rule))


def pages_sql(column: str, rule: str) -> str:
    other = "url" if column == "html" else "html"
    return f"(SELECT page_id, {other}, {rule} AS {column} FROM pages)"
