"""Composite jobs: one public function per model, dataset or report step of the reference."""
