"""Training-data operators: archives, near-duplicates, exact search, personal data, toxicity, main
text, tokenisation, URL and quality filters, benchmark decontamination, spelling variants, hard negatives.

Nothing outside this folder (and ``corpus_pipeline.py``) imports it. ``queries.py`` registers one
query per operator.
"""
