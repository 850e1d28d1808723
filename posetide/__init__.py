"""posetide — pose, box and heatmap analytics as Spark DataFrame jobs.

Sub-packages:
  sources    scans and sinks (tables, images, annotations, frames, results)
  functions  column-expression builders (boxes, keypoints, heatmaps, flags)
  operators  DataFrame -> DataFrame operators (suppression, decode, tracking,
             samples, metrics, scoring)
  plans      end-to-end jobs and the query registry
  streaming  Structured Streaming forms of the stateful operators
"""

__version__ = "0.1.0"
