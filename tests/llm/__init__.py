#: Queries that SQL can't express, each held against a brute-force version here.
WITHOUT_SQL = {
    "op1_minhash_dedup", "op2_byte_bpe", "op3_html_extract", "op5_token_counts", "op6_token_shards", "op7_toxicity",
    "op8_quality", "op10_hnsw_search", "op13_order_minhash", "pipeline"}
