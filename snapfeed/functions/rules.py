"""Rule tables and term lists used by the cleaning, classification and ranking jobs.

Everything in this module is data.  The values marked "fixed values" must equal
the source behaviour for results to agree, so they are kept verbatim, in their
original order, as plain text.  Regexes are written in Java syntax with inline
flags; they also compile in RE2 (the SQL oracle), except where noted.
"""

from __future__ import annotations

# ------------------------------------------------------------------------------------------
# Content clean-up rules (STR-8, "observed"), applied in this order, each
# replaced by the empty string.  Only change from the source text: the braces of the third
# rule are escaped, because Java rejects a bare "{" that is not a repetition.
# ------------------------------------------------------------------------------------------
CLEAN_RULES_OBSERVED = [
    r"(?is)<script[^>]*>[\s\S]*?</script>",
    r"""(?i)\son[a-z]+\s=\s["'][^"']["']?""",
    r"(?is)\(function\s\([^)]*\)\s\{[^}]\}[^}]\}\)\s*\([^)]*\);?",
    r"(?is)var\s+[^;]+;",
    r"(?is)const\s+[^;]+;",
    r"(?is)let\s+[^;]+;",
    r"(?is)ExCoPlayer\.[^;]+;?",
    r"(?is)PARSELY\.[^;]+;?",
    r"""(?is)\{\s["']?[a-zA-Z_$][a-zA-Z0-9_$]["']?\s:\s[^}]+\}""",
    r"(?is)\s[a-zA-Z_$][a-zA-Z0-9_$]*\s=\s[^;]+;?\s",
    r'(?is)<div[^>]class="exco-embed"[^>]>.*?</div>',
    r'(?is)<div[^>]id="[0-9a-f-]+"[^>]class="exco-embed"[^>]*></div>',
    r'(?is)<div[^>]*class="[^"]*Embed[^"]*"[^>]*>.*?</div>',
    r'(?is)<script[^>]*class="[^"]*exco-player[^"]*"[^>]*>.*?</script>',
    r"(?is)<div[^>]advert-container[^>]>.*?</div>",
    r"(?is)<div[^>]DFP_[^>]>.*?</div>",
    r"(?is)<aside[^>]OUTBRAIN[^>]>.*?</aside>",
    r"(?is)<div[^>]piano-container[^>]>.*?</div>",
    r"(?is)<div[^>]link-builder-block[^>]>.*?</div>",
    r"(?is)<span[^>]inline-image-caption[^>]>.*?</span>",
    r"(?is)<p[^>]*>\s*Read more posts\s*</p>",
    r"(?is)<div[^>]*>\s*Read more posts\s*</div>",
    r"(?is)<span[^>]*>\s*Read more posts\s*</span>",
    r"(?is)Read more posts",
    r"(?is)<hr>\s<p[^>]>\sWe're now on\s&nbsp;\sWhatsApp![^<]</p>\s*<hr>",
    r"(?is)<hr[^>]>\s<p[^>]>.?WhatsApp.?</p>\s<hr[^>]*>",
    r"(?is)<p[^>]>\sWe're now on WhatsApp![^<]*</p>",
    r"(?is)<p[^>]>We're now on WhatsApp![^<]?bit\.ly/[^<]*</p>",
    r"(?is)<p[^>]>.?We're now on WhatsApp.?bit\.ly/[^<].?</p>",
    r"(?is)if\s*\([^)]+\)\s*\{[^}]*\}",
    r"(?is)\$\([^)]*\)\.[^;]+;?",
    r"(?is)window\.[^;]+;?",
    r'(?is)<div[^>]*class="[^"]*link-builder-block[^"]*"[^>]*>.*?</div>',
]

# STR-8d ("documented"): the same rules, by position, with the repetition the comments describe
# restored where it is missing, and the three statement rules anchored at a word start so that prose
# words ending in "var"/"const"/"let" are left alone.  Entries are (pattern, replacement).
_WORD_START = r"(?is)(^|[^A-Za-z0-9_$])"
_DOCUMENTED = {
    1: (r"""(?i)\son[a-z]+\s*=\s*["'][^"']*["']?""", ""),
    2: (r"(?is)\(function\s*\([^)]*\)\s*\{[^}]*\}[^}]*\}\)\s*\([^)]*\);?", ""),
    3: (_WORD_START + r"var\s+[^;]+;", "$1"),
    4: (_WORD_START + r"const\s+[^;]+;", "$1"),
    5: (_WORD_START + r"let\s+[^;]+;", "$1"),
    8: (r"""(?is)\{\s*["']?[a-zA-Z_$][a-zA-Z0-9_$]*["']?\s*:\s*[^}]+\}""", ""),
    9: (r"(?is)\s[a-zA-Z_$][a-zA-Z0-9_$]*\s*=\s*[^;]+;?\s", " "),
    10: (r'(?is)<div[^>]*class="exco-embed"[^>]*>.*?</div>', ""),
    11: (r'(?is)<div[^>]*id="[0-9a-f-]+"[^>]*class="exco-embed"[^>]*></div>', ""),
    14: (r"(?is)<div[^>]*advert-container[^>]*>.*?</div>", ""),
    15: (r"(?is)<div[^>]*DFP_[^>]*>.*?</div>", ""),
    16: (r"(?is)<aside[^>]*OUTBRAIN[^>]*>.*?</aside>", ""),
    17: (r"(?is)<div[^>]*piano-container[^>]*>.*?</div>", ""),
    18: (r"(?is)<div[^>]*link-builder-block[^>]*>.*?</div>", ""),
    19: (r"(?is)<span[^>]*inline-image-caption[^>]*>.*?</span>", ""),
    24: (r"(?is)<hr>\s*<p[^>]*>\s*We're now on\s*&nbsp;\s*WhatsApp![^<]*</p>\s*<hr>", ""),
    25: (r"(?is)<hr[^>]*>\s*<p[^>]*>.*?WhatsApp.*?</p>\s*<hr[^>]*>", ""),
    26: (r"(?is)<p[^>]*>\s*We're now on WhatsApp![^<]*</p>", ""),
    27: (r"(?is)<p[^>]*>We're now on WhatsApp![^<]*bit\.ly/[^<]*</p>", ""),
    28: (r"(?is)<p[^>]*>.*?We're now on WhatsApp.*?bit\.ly/[^<]*?</p>", ""),
}
CLEAN_RULES_DOCUMENTED = [_DOCUMENTED.get(i, (pattern, "")) for i, pattern in enumerate(CLEAN_RULES_OBSERVED)]

# The description cleaner's replacements before and after its tag strip (STR-11).  Runs
# of line breaks are matched possessively: the plain repetition overflows Java's stack on long runs.
DESCRIPTION_RULES = [
    (r"(?is)<script[^>]*>.*?</script>|<style[^>]*>.*?</style>", ""), (r"(?i)&nbsp;", " "), (r"\s+", " "),
]
DESCRIPTION_TAG_RULES = [(r"<p[^>]*>", "<p>"), (r"<p>\s*</p>", ""), (r"(?:<br\s*+/?+>){3,}+", "<br><br>")]

# Block tags to line breaks, then line breaks to paragraphs (STR-12).
BLOCK_RULES = [(r"(?i)</p>", "\n\n"), (r"(?i)</?(div|br|h[1-6]|li|ul|ol|blockquote)[^>]*>", "\n")]
BLOCK_SPACE_RULES = [(r"[ \t]+", " "), (r"\n[ \t]+", "\n"), (r"[ \t]+\n", "\n")]
BLOCK_PARAGRAPH_RULES = [(r"\n{3,}", "\n\n"), (r"\n\n+", "</p><p>"), (r"\n", "<br>")]

# Line markers that drop a whole line of cleaned content (STR-9),
# compared case-insensitively.
SCRIPT_LINE_MARKERS = ["function", "var ", "const ", "let ", "= {", "}.", "addEventListener", "onload", "getElementById"]

# Advert classifier (F-6).
SUBSCRIPTION_TERMS = [
    "subscription", "subscribe", "digital subscription",
    "reader rewards", "special offer", "exclusive access",
    "unlimited access", "monthly subscription",
]
TITLE_OFFER_WORDS = ["months", "offer", "deal"]
STRONG_CONTENT_INDICATORS = [
    "terms and conditions apply",
    "subscription auto-renews",
    "newsquest media group",
    "digital subscription is the best way",
    "click here to subscribe",
]

# Junk-paragraph tests (F-2).
BODY_JUNK_PATTERN = r"(?i)cookie|subscribe|newsletter|advert|whatsapp"
FALLBACK_JUNK_TERMS = [
    "cookie", "subscribe", "newsletter", "whatsapp", "we're now on whatsapp",
    "join our new channel", "bit.ly/", "terms and conditions",
]
EXCERPT_JUNK_TERMS = [
    "advertisement", "subscribe", "newsletter", "cookie", "whatsapp",
    "we're now on whatsapp", "join our new channel", "bit.ly/",
    "function", "var ", "const ", "ExCoPlayer", "PARSELY", "getElementById",
    "addEventListener", "terms and conditions",
]
EXCERPT_JUNK_PATTERNS = [r"(?i)we're now on.*?whatsapp", r"(?i)whatsapp.*?bit\.ly", r"\(function|\{.\}|var\s+\w+\s="]
LEAD_JUNK_TERMS = ["whatsapp", "function", "var ", "ExCoPlayer"]
LEAD_JUNK_PATTERN = r"\(function|\{.*\}"

# Image URL block-list (IMG-2).
IMAGE_URL_BLOCKLIST = [
    "love-local", "logo", "icon", "banner", "small_site_logo",
    "social", "ipso", "advertisement", "tracker", "pixel",
    "1x1", "facebook", "twitter", "regulated", "footer", "header",
    "usa-today-logo",
]

# URL block for listing links (F-1).
URL_BLOCK_TERM = "advertisement"

# Selectors of the news generator.
LISTING_SELECTORS = ["ul.listing li", "article", "main#content a"]
NEXT_PAGE_SELECTOR = "a.pagination__next"
TAGS_CONTAINER_SELECTOR = "#article > div.mar-article > div > div.mar-article__article-tags"
TAG_SELECTOR = "div.article-tags"
LIVE_CONTENT_SELECTOR = "#liveArticleContent"
LIVE_SUMMARY_SELECTOR = "#live-article-content__livefeed-summary"
MAIN_CONTENT_SELECTOR = "#subscription-replace-entire-article"
HERO_IMAGE_SELECTORS = [
    ".mar-article-image img[srcset]",
    ".mar-article-image img[src]",
    ".article-hero img[srcset]",
    ".article-hero img[src]",
    ".featured-image img[srcset]",
    ".featured-image img[src]",
]
CONTENT_IMAGE_SELECTORS = [
    "#subscription-replace-entire-article img[srcset]",
    "#subscription-replace-entire-article img[src]",
]
COVERAGE_SELECTORS = [
    ("#liveArticleContent", "Live article content"),
    ("#live-article-content__livefeed-summary", "Live feed summary"),
    ("#subscription-replace-entire-article", "Main content area"),
    (".article-body", "Article body"),
    (".article-first-paragraph", "First paragraph"),
    (".block-article-content", "Block article content"),
    ("main article", "Main article tag"),
]

# Selectors of the HTML models generator.
MODEL_LINK_SELECTOR = "h3 a, h2 a"
MODEL_IMAGE_SELECTOR = ".model-media img, .gallery img"
MODEL_DESCRIPTION_SELECTOR = ".model-description, .description"
MODEL_AUTHOR_SELECTOR = ".author-name a, .username a"
MODEL_TAG_SELECTOR = ".tag-list a, .categories a, .model-tags a"
MODEL_DATE_SELECTOR = ".creation-date, .publish-date, time"

# Site constants.
NEWS_BASE = "https://www.echo-news.co.uk"
NEWS_LISTING = "https://www.echo-news.co.uk/news/"
JSON_SITE = "https://www.printables.com"
JSON_MEDIA = "https://media.printables.com/"
HTML_SITE = "https://makerworld.com"
DESCRIPTION_CAP = 800
DEFAULT_EXCERPT_LENGTH = 200
LIVE_SUFFIX = " - LIVE FEED"
MODEL_FALLBACK_SENTENCE = "<p>3D model available for download from Printables.com</p>"
JSON_FEED_NAME_PREFIX = "Printables.com - "
JSON_CONTENT_CLASS = "printables-model"
JSON_UID_PREFIX = "printables_"
HTML_FEED_NAME = "MakerWorld"
HTML_VIEW_LINK_TEXT = "View on MakerWorld"

# Category lookup tables (label, code), in source order.
JSON_CATEGORIES = [
    ("All Categories", None),
    ("3D Printer Accessories", "31"),
    ("Art", "88"),
    ("Fashion", "97"),
    ("Functional", "20"),
    ("Games", "19"),
    ("Gadgets", "11"),
    ("Hobby", "14"),
    ("Household", "3"),
    ("Learning", "84"),
    ("Miniatures", "10"),
    ("Models", "18"),
    ("RC Vehicles", "52"),
    ("Signs & Logos", "94"),
    ("Spare Parts", "16"),
    ("Sport & Outdoors", "25"),
    ("Tools", "15"),
    ("Toys", "12"),
]
HTML_CATEGORIES = [
    ("All Categories", ""),
    ("Hobby & DIY", "300"),
    ("Miniatures", "301"),
    ("Toys & Games", "302"),
    ("Home & Garden", "303"),
    ("Fashion", "304"),
    ("Tools & Gadgets", "305"),
    ("Art & Design", "306"),
    ("Educational", "307"),
    ("Automotive", "308"),
    ("Electronics", "309"),
    ("Jewelry", "310"),
    ("Sports & Outdoors", "311"),
    ("Medical & Science", "312"),
    ("Architecture", "313"),
    ("Food & Kitchen", "314"),
    ("Cosplay", "315"),
    ("Replacement Parts", "316"),
    ("Business & Industrial", "317"),
]
JSON_DAYS = [("Last 7 days", "7"), ("Last 30 days", "30"), ("Last 3 months", "90")]
HTML_DAYS = [("1 day", "1"), ("7 days", "7"), ("30 days", "30"), ("90 days", "90"), ("All time", "")]
JSON_SORTS = [("Trending", "trending"), ("Most Liked", "likes"), ("Most Downloaded", "downloads"), ("Most Recent", "newest")]
HTML_SORTS = [
    ("Hot Score", "hotScore"),
    ("Latest", "latest"),
    ("Most Liked", "mostLiked"),
    ("Most Downloaded", "mostDownloaded"),
    ("Most Collected", "mostCollected"),
]
# JSON sort -> remote ordering; anything else falls back to the first.
JSON_ORDERING = {
    "trending": "-likes_count_7_days",
    "likes": "-likes_count",
    "downloads": "-download_count",
    "newest": "-published",
}
LIMIT_MIN, LIMIT_MAX, LIMIT_DEFAULT = 1, 50, 20
