"""Training-data operators: language ID, deduplication, decontamination, chat formatting, packing, archives, licences."""
