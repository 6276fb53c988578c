"""Training-data operators: token counts and files, decontamination, deduplication, filters."""
