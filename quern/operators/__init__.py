"""Relational operators: inspection, duplicates, manifests, splits, checks, augmentation plans and evaluation."""
