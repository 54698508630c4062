"""Training-data operators: near-duplicate removal, formatting, scoring,
classification, mixing, decontamination and secret scans.

Nothing outside this subpackage imports it; its queries are in
``assetlife.llm.queries``.
"""
