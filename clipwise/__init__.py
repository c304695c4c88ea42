"""Clipwise: curation and evaluation of speech corpora as composable DataFrame transforms."""
