"""annolake: Spark jobs for detection, segmentation and tracking annotations."""
