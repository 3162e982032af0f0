"""op6: rules and boosted trees over all page urls."""

from parley.llm.registry import query
from parley.llm.urls import judge
from parley.registry.base import table


@query("op6_url_filters")
def url_filters(spark, sf_dir):
    """Host, path, fitting rule and verdict of every page's url."""
    return judge(table(spark, sf_dir, "pages"))
