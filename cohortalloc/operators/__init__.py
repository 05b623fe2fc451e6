"""Frame-to-frame building blocks of the allocation pipelines and audits."""
