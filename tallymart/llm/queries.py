"""The queries of this subpackage and the SQL each is compared with; None stands where SQL cannot express a query."""

from tallymart.llm import decontaminate, exact_dedup, jaccard, lexical_search, line_dedup, packing, quality_gam, quality_rules, quotation, resampling, substring_dedup, suffix_dedup, warc

MODULES = [quotation, quality_gam, line_dedup, packing, jaccard, warc, decontaminate, quality_rules, substring_dedup, suffix_dedup, lexical_search, resampling, exact_dedup]
QUERIES = {name: query for m in MODULES for name, query in m.QUERIES.items()}
ORACLE = {name: sql for m in MODULES for name, sql in m.SQL.items()}
