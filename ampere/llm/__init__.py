"""Training-data operators (language ID, fingerprints, token files, main-text
extraction, packing, quality scores, token counts, similarity join, quality
rules, BPE, vector codes, nearest neighbours, source divergence).  Nothing outside this subpackage imports it."""
