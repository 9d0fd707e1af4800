"""Readers and writers of the files that contracts come from and go to."""
