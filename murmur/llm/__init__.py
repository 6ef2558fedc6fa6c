"""Training-data operators: dedup, toxicity, chat formatting, packing, WARC, token counts,
decontamination and HTML extraction. Nothing else in the package imports this subpackage."""
