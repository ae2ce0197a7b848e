"""All queries of this package and their SQL twins."""

from valuekit.llm import bench_simhash, bpe_trees, gear_chunks, html_blocks, id_planes, kernel_quality, line_join, ngram_join, phrase_graph, phrase_prints, piece_counts, source_bitmaps, url_trees

_MODULES = (bench_simhash, bpe_trees, gear_chunks, html_blocks, id_planes, kernel_quality, line_join, ngram_join, phrase_graph, phrase_prints, piece_counts, source_bitmaps, url_trees)
QUERIES = {name: query for module in _MODULES for name, query in module.QUERIES.items()}
ORACLE = {name: sql for module in _MODULES for name, sql in module.ORACLE.items()}
