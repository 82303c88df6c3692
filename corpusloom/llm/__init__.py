"""Training-data operators: thirteen operators over documents, pages, conversations and a shop's sales.

Nothing outside this subpackage imports it; `queries` holds the registered queries.
"""
