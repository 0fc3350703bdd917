"""Readers and writers: catalogue documents, snapshots, scratch tables, reshaping."""
