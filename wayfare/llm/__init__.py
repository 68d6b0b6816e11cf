"""Training-data operators: scoring, mixing, packing, quality, language, licences, fingerprints, tokens, near copies, hosts."""
