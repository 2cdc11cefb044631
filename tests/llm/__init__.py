"""Tests of the training-data operators; a package, as file names occur in both folders."""
