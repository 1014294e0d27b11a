"""Named datasets and jobs put together from the operators."""
