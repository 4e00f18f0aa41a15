"""Schemas of the stored artifacts, in column order."""

FRAME = "document string, frame_index bigint, fps double, width int, height int, data binary"

#: The headers of the CSV files.
EXTRACTION_LOG_HEADER = ["序号", "时间(分:秒)", "时间戳(秒)", "文件名", "原始尺寸", "状态"]
SYMBOL_MAP_HEADER = {"行": "row", "列": "col", "符号": "symbol"}
GRID_RESULT_HEADER = ["file", "time_s", "row", "col", "status", "px", "py", "符号"]
#: The states of a sampled frame.
NORMAL, SKIPPED = "正常", "跳过(尺寸异常)"
