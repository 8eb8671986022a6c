"""Preparation of texts for language models. Nothing outside this subpackage imports it."""
