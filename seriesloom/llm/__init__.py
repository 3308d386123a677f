"""Operators of a training-data pipeline over web pages, documents and conversations.

Each module holds one operator with its own interface; :mod:`.queries` registers one query per
operator. Nothing outside this folder imports it.
"""
