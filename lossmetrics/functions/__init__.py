"""Column helpers and mergeable distributions shared by the operators."""
