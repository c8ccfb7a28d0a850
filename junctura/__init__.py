"""Very short exons in RNA-sequencing data, as PySpark DataFrames: discovery, quantification, comparison."""
