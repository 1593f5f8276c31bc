"""End-to-end plans: wide table, multi-partner table, scorecard, publication."""
