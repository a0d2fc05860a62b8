"""Text, graph and time-bucket analytics on Spark DataFrames."""

from .functions.hours import hour_key, parse_message_date, text_hour
from .functions.text import alpha_tokens, snippet, ws_tokens
from .operators.cooccur import cooccurrence, pair_counts, pmi, stripes, top_pair, top_partners
from .operators.counts import at_positions, distinct_terms, doc_freq, line_count, part_positions, tokenize, vocab_positions, word_count
from .operators.graph import (
    duplicate_nodes,
    graph_stats,
    hash_partition,
    load_graph,
    missing_nodes,
    range_partition,
    save_graph,
)
from .operators.hourly import EGYPT_CAIRO, hourly_counts, hourly_counts_text
from .operators.pagerank import (
    format_top,
    from_log_mass,
    init_ranks,
    iteration_metrics,
    load_transitions,
    log_mass,
    log_sum_exp,
    ppr,
    ppr_logs,
    ppr_step,
    run_ppr,
    save_transitions,
    top_k,
    top_k_per_source,
    total_mass,
    transitions,
    write_top_k,
)
from .operators.postings import (
    build_postings,
    decode_gaps,
    encode_gaps,
    forward_index,
    gap_lists,
    lookup_postings,
    lookup_terms,
    postings_lists,
    postings_map,
    term_df,
    tf_histogram,
    with_shard,
)
from .operators.search import bool_and, bool_or, bool_search, fetch_lines, search_index
from .sinks.index import load_block_index, save_block_index, save_collection, save_lookup, save_postings, save_wide_table, write_index
from .sinks.text import write_tsv, write_tuples
from .sources.adjacency import parse_adjacency, read_adjacency
from .sources.lines import documents_of, lines_of, read_lines, read_lines_with_offset
from .sources.messages import parse_messages, read_messages
