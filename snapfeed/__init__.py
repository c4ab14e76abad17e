"""snapfeed: page-to-feed analytics as Spark jobs.

Entry points: ``snapfeed.plans.catalog.queries()`` / ``oracle_sql()`` (every registered
query), ``snapfeed.plans.news.article_items`` / ``news_crawl_items`` (news feeds),
``snapfeed.plans.models`` (record feeds), ``snapfeed.plans.nodes_queries.html_model_items``,
``snapfeed.streaming.incremental`` (streaming forms), ``snapfeed.session.get_spark``.
"""
