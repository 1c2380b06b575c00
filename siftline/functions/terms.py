"""Default term lists and lookup tables. All are parameters of the functions that use them.

Fixed values: these must equal the published defaults for right results.
"""

NOISE_TERMS = [
    "长者版", "无障碍", "首页", "当前位置", "打印本页", "关闭窗口", "上一篇", "下一篇",
    "分享到", "责任编辑", "网站地图", "主办单位", "版权所有", "ICP备案", "English", "网站支持IPv6",
]

ROUTE_NAV_TERMS = ["首页", "网站首页", "机构信息", "网站地图", "联系我们", "返回旧版", "当前位置", "上一篇", "下一篇", "招生招聘", "中心简介"]
ROUTE_FOOTER_TERMS = ["版权所有", "京ICP备", "京公网安备", "联系方式", "微信公众号"]
ROUTE_PREV_NEXT_TERMS = ["上一篇", "下一篇"]
ROUTE_STRONG_TERMS = ["联系我们 | 网站地图", "当前位置： 首页", "当前位置：首页", "上一篇：", "下一篇：", "京ICP备", "京公网安备"]
ROUTE_STARTS = ["首页 ", "网站首页 ", "联系我们 | 网站地图"]

ATTACHMENT_FLAGS = {
    "pdf": "pdf_attachment", "doc": "doc_attachment", "docx": "doc_attachment", "xls": "xls_attachment",
    "xlsx": "xls_attachment", "csv": "xls_attachment", "png": "image_attachment", "jpg": "image_attachment",
    "jpeg": "image_attachment", "gif": "image_attachment", "bmp": "image_attachment", "webp": "image_attachment",
    "zip": "archive_attachment", "rar": "archive_attachment", "7z": "archive_attachment",
}

ANOMALY_NAV_TERMS = ["首页", "机构", "新闻", "信息", "服务", "互动", "专题", "政务公开", "政务服务", "互动交流", "机构职能"]
ANOMALY_LIST_TITLES = ["工作动态", "通知公告", "政务动态", "新闻中心", "信息公开"]

ORG_BY_DOMAIN = {
    "nhc.gov.cn": "国家卫生健康委员会", "ndcpa.gov.cn": "国家疾病预防控制局", "chinacdc.cn": "中国疾病预防控制中心",
    "ncncd.chinacdc.cn": "中国疾控中心慢病中心", "nhsa.gov.cn": "国家医疗保障局", "hsa.gd.gov.cn": "广东省医疗保障局",
    "wsjkw.gd.gov.cn": "广东省卫生健康委员会", "cdcp.gd.gov.cn": "广东省疾病预防控制中心", "natcm.gov.cn": "国家中医药管理局",
    "ncmhc.org.cn": "国家心理健康和精神卫生防治中心", "cncaprc.gov.cn": "中国老龄协会", "sport.gov.cn": "国家体育总局",
    "who.int": "World Health Organization", "wjw.gz.gov.cn": "广州市卫健委", "kepu.wjw.gz.gov.cn": "广州健康科普平台",
}
ORG_BY_ID_PREFIX = {"gz_广州市卫健委_": "广州市卫健委", "gz_广州市医保局_": "广州市医保局", "gz_广州健康科普平台_": "广州健康科普平台"}
CHANNEL_NAMES = {
    "zhengce": "政策文件", "nhsa_notices": "通知公告", "nhsa_policy_regulations": "政策法规",
    "nhsa_policy_interpretation": "政策解读", "nhsa_statistics": "统计数据", "nhsa_public_services": "公共服务",
    "gd_nhsa_news": "医保动态", "gd_nhsa_notices": "通知公告", "gd_nhsa_drug_catalog": "药品目录",
    "publication": "publication", "technical-document": "technical-document", "meeting-report": "meeting-report",
    "report": "report", "guideline": "guideline",
}

#: Literals that are blanked inside lines, then navigation, footer and paging terms of page chrome. The last entries of
#: each are mis-decoded spellings found in old crawls; they are meant to look like that.
HARD_LITERALS = [
    "网站支持IPv6", "网站支持ipv6", "长者助手", "长者版", "长者浏览模式", "无障碍", "无障碍浏览", "无障碍模式", "打印本页",
    "【打印】", "关闭窗口", "【关闭】", "&nbsp", "分享到：", "分享到:", "：分享", ":分享", "微信扫一扫", "扫一扫", "手机扫码查看",
    "扫码分享", "视力保护色：", "【字体:大 中 小】", "【字体：大 中 小】", "字号：[ 大 中 小 ]", "字号：[大 中 小]", "字号：大 中 小",
    "【大 中 小】", "附件下载", "查看附件", "文件下载", "刷新 重试 诊断", "code：", "code:", "vid:", "uuid:", "requestId:",
    "播放时间：", "提示信息", "字幕 倍速 清晰度", "字幕 音轨 清晰度", "音轨 倍速 正常", "视频下载：", "宣教视频下载：", "00:00 / 00:00",
    "确认 取消", "404 Not Found", "nginx", "缃戠珯鏀\ue21b寔IPv6", "闀胯€呭姪鎵?", "闀胯€呯増", "鎵撳嵃鏈\ue104〉", "鍏抽棴绐楀彛",
    "鍒嗕韩鍒帮細", "寰\ue1bb俊鎵\ue0a1竴鎵?", "鎵嬫満鎵\ue0a4爜鏌ョ湅", "闄勪欢涓嬭浇", "鏂囦欢涓嬭浇",
]
NAV_TERMS = [
    "首页", "网站首页", "网站地图", "联系我们", "当前位置", "机构职能", "机构信息", "机构概况", "中心简介", "中心领导", "组织机构",
    "政务动态", "政务公开", "政务服务", "互动交流", "新闻中心", "工作动态", "通知公告", "政策法规", "政策解读", "专题专栏", "公共服务",
    "在线调查", "招生招聘", "招聘信息", "健康主题", "资源共享", "业务指导", "English", "Français", "Español", "Fran莽ais",
    "Espa帽ol", "English 中文", "棣栭〉", "缃戠珯棣栭〉", "缃戠珯鍦板浘", "鑱旂郴鎴戜滑", "褰撳墠浣嶇疆",
]
FOOTER_TERMS = [
    "版权所有", "版权与免责声明", "ICP备案", "公安备案", "公网安备", "政府网站标识码", "网站标识码", "主办单位", "承办单位", "技术支持",
    "官方微信", "官方微博", "网站导航", "直属单位", "网站声明", "相关链接", "相关附件", "相关文件", "政府网站", "部门网站", "下属单位",
    "网站信息", "粤ICP备20001927号-1", "新媒体矩阵", "广州健康通微信公众号", "广州健康通小程序", "@健康广州微博", "广州卫健委南方号",
    "广州卫健委微信公众号", "广州卫健委微信视频号", "广州地区互联网医院导引平台", "Copyright", "Reference numbers",
    "WHO Reference Number", "Number of pages", "Editors", "WHO Team", "国家部委", "省政府及省直部门", "中共广东省纪委", "纪检监察组",
    "联系电话", "联系地址", "寄信地址", "邮政编码", "邮编", "主办：", "承办：", "鐗堟潈鎵€鏈?", "ICP澶囨\ue50d", "浜\ue100叕缃戝畨澶?",
    "浜琁CP澶?", "缃戠珯鏍囪瘑鐮?", "鑱旂郴鐢佃瘽", "鎶€鏈\ue21b敮鎸?", "瀹樻柟寰\ue1bb俊",
]
PREV_NEXT_TERMS = ["上一篇", "下一篇", "上一页", "下一页", "涓婁竴绡囷細", "涓嬩竴绡囷細"]
