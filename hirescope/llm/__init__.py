"""Training-data operators: sharding, secret scans, line dedup, language ID,
WARC normalising, decontamination, n-best segmentation, exact top-k search,
quality scoring and the n-gram Jaccard join.

Nothing outside this subpackage imports it; its queries and their SQL live in
``hirescope.llm.queries`` and ``hirescope.llm.oracle``.
"""
