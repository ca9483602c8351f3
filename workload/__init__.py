"""Queries over the star-schema tables, one per operator, with their SQL counterparts."""

from workload import documents, incremental, layers, learning, loading, loads, plant, published, quality, streams

ALL = {
    **learning.QUERIES,
    **incremental.QUERIES,
    **quality.QUERIES,
    **documents.QUERIES,
    **loading.QUERIES,
    **streams.QUERIES,
    **layers.QUERIES,
    **published.QUERIES,
    **plant.QUERIES,
    **loads.QUERIES,
}
