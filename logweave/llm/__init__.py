"""Operators for large training corpora. Nothing outside this subpackage
imports it; :mod:`logweave.llm.catalog` holds its queries and their SQL."""
