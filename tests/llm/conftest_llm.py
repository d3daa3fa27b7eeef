"""Shared by the tests of the training-data operators."""

#: Names that operators use for columns of their own.
CLASHES = ("row", "body", "doc", "tk", "sure", "spans", "size", "taken", "key", "part", "host", "text_key", "kept", "bucket", "rep",
           "component", "component_id", "twin", "epoch", "words", "score", "held_out", "_text", "n_words", "n_removed", "kept_id")
