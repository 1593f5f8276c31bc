"""Incremental state: ledgers, record stores and a bounded file stream that hosts them."""
