"""Batch operators: one public function per inventory ID, DataFrames in and out."""
