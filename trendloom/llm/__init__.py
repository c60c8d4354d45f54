"""Training-data operators: deduplication, scoring, tokens, media, chat, decontamination."""
