"""Queries of the corpus operators, one ``opN_<name>`` each, and their SQL where DuckDB can express them."""
from __future__ import annotations

from renewcast.llm.alignment import op13_alignment
from renewcast.llm.bpe import op7_bpe
from renewcast.llm.decontaminate import op4_decontaminate
from renewcast.llm.hard_negatives import op11_hard_negatives
from renewcast.llm.jaccard_join import op6_jaccard_join
from renewcast.llm.line_dedup import OP9_SQL, op9_line_dedup
from renewcast.llm.neighbours import op8_neighbours
from renewcast.llm.packing import op12_packing
from renewcast.llm.substring_dedup import op1_substring_dedup
from renewcast.llm.suffix_dedup import op2_suffix_dedup
from renewcast.llm.token_files import op10_token_counts
from renewcast.llm.toxicity import op5_toxicity
from renewcast.llm.warc import op3_warc

QUERIES = {f.__name__: f for f in (op1_substring_dedup, op2_suffix_dedup, op3_warc, op4_decontaminate, op5_toxicity, op6_jaccard_join, op7_bpe, op8_neighbours, op9_line_dedup, op10_token_counts, op11_hard_negatives, op12_packing, op13_alignment)}

SQL: dict[str, str] = {"op9_line_dedup": OP9_SQL}
