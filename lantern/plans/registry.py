"""All registered queries: name -> (query, SQL counterpart or None)."""

from lantern.plans import evaluation, preferences, retrieval, streams

QUERIES = {
    **evaluation.QUERIES,
    **preferences.QUERIES,
    **retrieval.QUERIES,
    **streams.QUERIES,
}
