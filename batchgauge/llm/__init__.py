"""Training-data operators: formatting, extraction, classification, dedup, decontamination and mixing."""
