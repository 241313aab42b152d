"""Preparation of training corpora: thirteen operators over documents, pages and conversations."""
