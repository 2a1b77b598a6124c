"""Training-data operators: near-dedup, tokenizers, extraction, decontamination,
filters and vector search as Spark jobs. Nothing else in pmflow imports this
subpackage; its queries live in ``pmflow.llm.queries``."""
