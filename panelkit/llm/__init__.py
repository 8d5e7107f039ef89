"""Operators for preparing text corpora, pages and embeddings for model training.

Each module holds one operator with its own general interface;
``panelkit.llm.queries`` applies them to the driver tables. Nothing outside
this folder imports it.
"""
