"""Training-data operators: ten corpus operators over documents, pages and benchmark items.

Nothing outside this subpackage imports it.  Each module holds one operator;
``queries`` holds the registered queries and their SQL.
"""
